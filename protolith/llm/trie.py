"""Prefix trie of rebuilt conversations, by composable fingerprints.

A rebuilt conversation is a head of one conversation followed by a suffix of another.  Its texts are
never put together: every turn is a symbol of a polynomial hash, and the hash of a run of turns is an
element of a monoid (a sum, and the power its length stands for), so the fingerprint of any prefix of a
rebuilt conversation follows from the running sums of its two sources,

    P(head, h') + (P(own, j) - P(own, h)) * B ** (h' - h)

modulo two primes, where h' turns of the head are there.  Prefixes of the same depth and fingerprint
are one node.  Equality is checked: each distinct (role, text) is stored once and known by its number, and all
members of a node must agree in the number of their last turn and in the fingerprint of the prefix
before.  By induction over the depth they then agree in all turns.  Should two different prefixes meet in
a fingerprint, other bases are taken and the nodes are made anew.

Sums over subtrees need no walk over the tree.  Every node is on the path of its smallest member, so
what a node carries is put on that path, summed from the end, and added up over the members of each
node above.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from protolith.operators.ordered import climb, dealt, number_rows, scan
from protolith.session import stored

FAMILY, HEADS = 5, 9
PRIMES = (2_147_483_647, 2_147_483_629)
#: Bases of the two polynomials, one pair for each attempt.
BASES = ((1_000_003_919, 1_736_504_101), (1_402_946_773, 987_654_361), (734_592_011, 1_888_412_077), (1_623_456_787, 654_321_019))
#: Turns of one conversation that are summed in one window.
BIN = 4096
#: Conversation ids that are joined into one piece of text.
RUN = 512


def _long(value: int) -> Column:
    return F.lit(value).cast("long")


def _power(exponent: Column, base: int, prime: int, bits: int) -> Column:
    """``base ** exponent`` modulo ``prime``, from the exponent's bits."""
    out = _long(1)
    for i in range(bits):
        is_set = F.shiftright(exponent, i).bitwiseAND(_long(1)) == 1
        out = out * F.when(is_set, _long(pow(base, 1 << i, prime))).otherwise(_long(1)) % _long(prime)
    return out


def turns_in_order(conversations: DataFrame) -> DataFrame:
    """``conv, pos, ref, bytes``: the turns of each conversation from 1, each with the number of its (role, text).

    Texts are compared as they are, once; the numbers keep their order, so rows with the same turn are ordered by
    role, then text.
    """
    rows = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    known = stored(number_rows(rows.select("role", "text").distinct(), ["role", "text"], out="ref"), "turn-texts")
    placed = dealt(rows.join(known, ["role", "text"]).select("conv", "turn", "ref", F.octet_length("text").cast("long").alias("bytes")),
                   ["conv", "turn", "ref"], label="turns")
    counted = climb(placed.rows, placed.bins, sums={"__n": _long(1)}, lags={"__before": F.col("conv")})
    head = F.when(~F.col("__before").eqNullSafe(F.col("conv")), F.col("__n"))
    first = climb(counted, placed.bins, peaks={"__first": head})
    return first.select("conv", (F.col("__n") - F.col("__first") + 1).alias("pos"), "ref", "bytes")


def _combine(parts: list[Column]) -> Column:
    return F.shiftleft(parts[0], 31).bitwiseOR(parts[1])


def prefixes(turns: DataFrame, bases: tuple[int, int]) -> DataFrame:
    """``conv, depth, ref, bytes, print, before``: every prefix of every rebuilt conversation.

    ``print`` is its fingerprint, ``before`` that of the prefix without the last turn; both are sums and
    differences of running hashes, and ``ref`` points to the stored turn.
    """
    longest = turns.agg(F.max("pos").alias("m")).first().m or 0
    terms = {f"p{i}": (F.pmod(F.xxhash64("ref", F.lit(base)), _long(prime - 1)) + 1)
             * _power(F.col("pos"), base, prime, longest.bit_length()) % _long(prime) for i, (base, prime) in enumerate(zip(bases, PRIMES))}
    summed = scan(turns.withColumns(terms), ["conv"], F.floor(F.col("pos") / BIN), ["pos"], sums={f"s{i}": F.col(f"p{i}") for i in (0, 1)})
    # q: hash of the turns before this one, p: with it
    running = summed.select("conv", "pos", "ref", "bytes", *((F.col(f"s{i}") % _long(p)).alias(f"q{i}") for i, p in enumerate(PRIMES)),
                            *(((F.col(f"s{i}") + F.col(f"p{i}")) % _long(p)).alias(f"p{i}") for i, p in enumerate(PRIMES)))
    running = stored(running, "running")
    heads = running.filter(F.col("pos") < HEADS)

    lengths = running.groupBy("conv").agg(F.max("pos").alias("own"))
    convs = lengths.select("conv", (F.crc32(F.col("conv").cast("string")) % HEADS).alias("h"), (F.col("conv") - F.col("conv") % FAMILY).alias("base"))
    convs = convs.join(lengths.select(F.col("conv").alias("base"), F.col("own").alias("there")), "base", "left")
    convs = convs.withColumn("got", F.least("h", F.coalesce("there", _long(0)))).drop("there")
    end_of_head = heads.select(F.col("conv").alias("base"), F.col("pos").alias("got"), *(F.col(f"p{i}").alias(f"head{i}") for i in (0, 1)))
    skipped = heads.select("conv", F.col("pos").alias("h"), *(F.col(f"p{i}").alias(f"skip{i}") for i in (0, 1)))
    convs = convs.join(end_of_head, ["base", "got"], "left").join(skipped, ["conv", "h"], "left")
    convs = stored(convs.fillna(0, ["head0", "head1", "skip0", "skip1"]), "rebuilt")

    from_head = convs.select("conv", "got", "base").join(
        heads.withColumnRenamed("conv", "base"), "base").filter(F.col("pos") <= F.col("got")).select(
        "conv", F.col("pos").alias("depth"), "ref", "bytes", _combine([F.col("p0"), F.col("p1")]).alias("print"), _combine([F.col("q0"), F.col("q1")]).alias("before"))
    own = running.join(convs, "conv").filter(F.col("pos") > F.col("h"))

    def shifted(name: str) -> Column:
        parts = []
        for i, (base, prime) in enumerate(zip(bases, PRIMES)):
            back = _power(F.col("h") - F.col("got"), pow(base, -1, prime), prime, HEADS.bit_length())
            parts.append((F.col(f"head{i}") + F.pmod(F.col(f"{name}{i}") - F.col(f"skip{i}"), _long(prime)) * back) % _long(prime))
        return _combine(parts)

    from_own = own.select("conv", (F.col("pos") - F.col("h") + F.col("got")).alias("depth"), "ref", "bytes", shifted("p").alias("print"), shifted("q").alias("before"))
    roots = convs.select("conv", _long(0).alias("depth"), _long(-1).alias("ref"), _long(0).alias("bytes"), _long(0).alias("print"), _long(-1).alias("before"))
    return roots.unionByName(from_head).unionByName(from_own)


def nodes_of(paths: DataFrame) -> DataFrame:
    """One row per (depth, fingerprint), with ``same``: whether its members agree in their last turn and the prefix before."""
    return paths.groupBy("depth", "print").agg(
        F.count(F.lit(1)).alias("n_convs"), F.min("conv").alias("conv_id"), F.max("bytes").alias("bytes"), F.max("before").alias("before"),
        ((F.min("ref") == F.max("ref")) & (F.min("before") == F.max("before"))).alias("same"))


def end_digests(ends: DataFrame) -> DataFrame:
    """``depth, print, ends_sha256`` of the conversations ``conv`` that end in a node.

    Ids are sorted over the cluster and joined in runs; a digest is fed run by run, so a
    node with very many ends needs no list of them.
    """
    placed = dealt(ends.select("depth", "print", "conv"), ["depth", "print", "conv"], label="ends").rows
    runs = placed.groupBy("depth", "print", "__bin", F.floor(F.col("__at") / RUN).alias("run")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("conv")), lambda c: c.cast("string")), ",").alias("ids"))
    line = runs.repartition("depth", "print").sortWithinPartitions("depth", "print", "__bin", "run").select("depth", "print", "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, hashlib.sha256()
        for batch in batches:
            out = []
            for depth, print_, ids in zip(*(column.to_pylist() for column in batch.columns)):
                if (depth, print_) == node:
                    digest.update(b",")
                else:
                    if node is not None:
                        out.append((*node, digest.hexdigest()))
                    node, digest = (depth, print_), hashlib.sha256()
                digest.update(ids.encode())
            yield rows_of(out)
        yield rows_of([(*node, digest.hexdigest())] if node is not None else [])

    def rows_of(out: list) -> pa.RecordBatch:
        depth, print_, digest = zip(*out) if out else ((), (), ())
        return pa.RecordBatch.from_arrays([pa.array(depth, pa.int64()), pa.array(print_, pa.int64()), pa.array(digest, pa.string())],
                                          ["depth", "print", "ends_sha256"])

    return line.mapInArrow(run, "depth long, print long, ends_sha256 string")


def prefix_trie(conversations: DataFrame, bases=BASES) -> DataFrame:
    """Nodes of the trie of all rebuilt conversations.

    Conversation ``c`` becomes the first ``h`` turns of conversation ``c - c % 5`` (what there is of
    them), then its own turns after its first ``h``, where ``h`` is crc32(decimal c) modulo 9.  Returns, for
    each distinct sequence of first turns, ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``,
    ``n_children``, ``n_leaves``, ``saved_tokens`` and ``ends_sha256``.

    Turns are ordered by ``turn``, NULL first, then by role and text; repeated rows are turns of
    their own.  A NULL role or text is empty.  Rows without a ``conv_id`` belong to no conversation.  An empty
    table has no node, not even a root.  Very long texts are compared once and then known by number.  Other
    columns may have any name.
    """
    turns = stored(turns_in_order(conversations), "turns-in-order")
    for pair in bases:
        paths = stored(prefixes(turns, pair), "paths")
        nodes = stored(nodes_of(paths), "nodes")
        if nodes.filter(~F.col("same")).isEmpty():
            break
    else:
        raise ArithmeticError("prefixes collide under all bases")

    below = nodes.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("before").alias("print")).agg(F.count(F.lit(1)).alias("n_children"))
    above = nodes.select((F.col("depth") + 1).alias("depth"), F.col("print").alias("before"), F.col("conv_id").alias("parent_conv_id"))
    nodes = nodes.join(below, ["depth", "print"], "left").fillna(0, ["n_children"])
    nodes = stored(nodes.withColumn("leaf", (F.col("n_children") == 0).cast("long")), "nodes-with-children")

    carried = nodes.select(F.col("conv_id").alias("conv"), "depth", "leaf", ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"))
    steps = paths.select("conv", "depth", "print").join(carried, ["conv", "depth"], "left").fillna(0, ["leaf", "saved"])
    # from the end of each path to its root
    summed = scan(steps, ["conv"], F.floor(-F.col("depth") / BIN), [-F.col("depth")], sums={"leaves": F.col("leaf"), "more": F.col("saved")})
    totals = summed.groupBy("depth", "print").agg(F.sum(F.col("leaves") + F.col("leaf")).alias("n_leaves"), F.sum(F.col("more") + F.col("saved")).alias("saved_tokens"))

    last = paths.groupBy("conv").agg(F.max("depth").alias("depth"))
    ends = end_digests(paths.select("conv", "depth", "print").join(last, ["conv", "depth"]))
    nothing = hashlib.sha256(b"").hexdigest()
    out = nodes.join(totals, ["depth", "print"]).join(ends, ["depth", "print"], "left").join(above, ["depth", "before"], "left")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                      F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"))
