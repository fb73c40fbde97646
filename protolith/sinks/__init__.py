"""Writers: NULL becomes the format's own token only here."""
