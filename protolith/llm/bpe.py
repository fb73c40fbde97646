"""Byte-pair encoding and decoding with a given public vocabulary.

Texts are cut into pieces (contractions, letters, numbers, other characters, white
space) by character classes over a whole block.  Each distinct piece of a block is
encoded once.  A short piece is a row of part ids beside the ranks of its adjacent
pairs; all rows of one width take part in the same scan: find the smallest rank,
write the merged part, delete the boundary, look up the two ranks that changed.
A piece too long for that goes through a heap over linked parts, with the same result.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .textkit import blocks, ranges

NONE = np.int32(1 << 30)
SHORT = 48
LETTER, NUMBER, SPACE, OTHER = 1, 2, 3, 4
# Unicode White_Space (fixed values)
WHITE = (9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary, and the byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def _classes() -> np.ndarray:
    import unicodedata

    kinds = {"L": LETTER, "N": NUMBER}
    out = np.full(0x110000, OTHER, dtype=np.uint8)
    for c in range(0x110000):
        kind = kinds.get(unicodedata.category(chr(c))[0])
        if kind:
            out[c] = kind
    out[list(WHITE)] = SPACE
    return out


class Codec:
    """Encoder and decoder for one vocabulary file of the ``tokenizers`` library (byte-level BPE)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        alphabet = byte_alphabet()
        size = max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])]) + 1
        self.bytes_of: list[bytes] = [b""] * size
        for token, i in vocab.items():
            self.bytes_of[i] = bytes(alphabet[c] for c in token)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for content, i in self.special.items():
            self.bytes_of[i] = content.encode()
        self.text_of = [str(i) for i in range(size)]
        first = np.zeros(256, dtype=np.int32)
        for char, b in alphabet.items():
            first[b] = vocab[char]
        self.first = first
        pairs = [m if isinstance(m, list) else m.split(" ") for m in merges]
        left = np.array([vocab[a] for a, _ in pairs], dtype=np.int64)
        right = np.array([vocab[b] for _, b in pairs], dtype=np.int64)
        merged = np.array([vocab[a + b] for a, b in pairs], dtype=np.int32)
        self.shift = int(size).bit_length()
        keys = (left << self.shift) | right
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank, self.merged = keys[order], order.astype(np.int32), merged
        self.byte_rank = self._look(np.repeat(first, 256), np.tile(first, 256)).reshape(256, 256)
        self.classes = _classes()

    # pieces

    def cut(self, data: np.ndarray, start: np.ndarray) -> np.ndarray:
        """Byte offsets at which the pieces of a block begin."""
        text = data.tobytes().decode("utf-8", "replace")
        code = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
        if not len(code):
            return np.zeros(0, np.int64)
        at = np.flatnonzero((data & 0xC0) != 0x80)
        kind = self.classes[code]
        n = len(code)
        doc = np.zeros(n + 1, dtype=bool)
        doc[np.searchsorted(at, start[:-1][start[:-1] < len(data)])] = True
        doc[n] = True
        opens = np.ones(n, dtype=bool)          # a run of one class begins here
        opens[1:] = kind[1:] != kind[:-1]
        opens |= doc[:n]
        space = kind == SPACE
        shut = np.ones(n, dtype=bool)           # a run ends with this character
        shut[:-1] = opens[1:]
        begins = opens.copy()
        # the last white space before other characters leaves its run; a blank joins what follows
        tail = space & shut & ~doc[1:]
        begins[tail] = True
        joined = np.flatnonzero(tail & (code == 32))
        begins[joined + 1] = False
        # contractions begin at an apostrophe that nothing before has taken
        mark = np.flatnonzero((code == 39) & opens)
        mark = mark[(mark + 1 < n)]
        if len(mark):
            free = np.ones(len(mark), dtype=bool)
            behind = mark > 0
            free[behind] = begins[mark[behind]]
            mark = mark[free & ~doc[mark + 1]]
            c1 = code[mark + 1]
            two = np.minimum(mark + 2, n - 1)
            c2 = np.where((mark + 2 < n) & ~doc[two], code[two], 0)
            one = np.isin(c1, [ord(c) for c in "stmd"])
            both = ((c1 == ord("r")) & (c2 == ord("e"))) | ((c1 == ord("v")) & (c2 == ord("e"))) \
                | ((c1 == ord("l")) & (c2 == ord("l")))
            length = np.where(one, 2, np.where(both, 3, 0))
            mark, length = mark[length > 0], length[length > 0]
            begins[mark + 1] = False
            after = mark + length
            after = after[after < n]
            # what follows a contraction starts a piece, unless a blank already did
            begins[after] = True
        return at[begins]

    # merging

    def _look(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs of part ids; NONE where the vocabulary has no such pair."""
        key = (left.astype(np.int64) << self.shift) | right
        place = np.searchsorted(self.keys, key)
        place[place == len(self.keys)] = 0
        return np.where(self.keys[place] == key, self.rank[place], NONE)

    def _merge_rows(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge equally long pieces (bytes), one per row; ids from the left, and how many there are."""
        parts = self.first[data]
        n, width = parts.shape
        done, count, rows = parts.copy(), np.full(n, width), np.arange(n)
        ranks = self.byte_rank[data[:, :-1], data[:, 1:]]
        while width > 1:
            spot = ranks.argmin(axis=1)
            best = ranks[np.arange(len(rows)), spot]
            live = best < NONE
            if not live.all():
                over = ~live
                done[rows[over], :width] = parts[over]
                count[rows[over]] = width
                rows, parts, ranks, spot, best = (x[live] for x in (rows, parts, ranks, spot, best))
            if not len(rows):
                return done, count
            line = np.arange(len(rows))
            parts[line, spot] = self.merged[best]
            # every row loses one boundary, so all rows stay equally long
            keep = np.ones(parts.shape, dtype=bool)
            keep[line, spot + 1] = False
            parts = parts[keep].reshape(len(rows), width - 1)
            keep = keep[:, :-1]
            keep[:] = True
            keep[line, spot] = False
            ranks = ranks[keep].reshape(len(rows), width - 2)
            width -= 1
            before, behind = np.flatnonzero(spot > 0), np.flatnonzero(spot + 1 < width)
            row = np.concatenate([before, behind])
            left = np.concatenate([spot[before] - 1, spot[behind]])
            ranks[row, left] = self._look(parts[row, left], parts[row, left + 1])
        done[rows, :1] = parts
        count[rows] = 1
        return done, count

    def _merge_long(self, parts: list[int]) -> list[int]:
        """One long piece: a heap of ranks over linked parts."""
        n = len(parts)
        nxt, prev, dead = list(range(1, n + 1)), list(range(-1, n - 1)), [False] * n
        ids = np.array(parts, dtype=np.int64)
        first = self._look(ids[:-1], ids[1:])
        heap = [(int(r), i, parts[i], parts[i + 1]) for i, r in enumerate(first) if r < NONE]
        heapq.heapify(heap)
        known: dict[tuple[int, int], int] = {}

        def offer(i: int, j: int) -> None:
            pair = (parts[i], parts[j])
            if pair not in known:
                known[pair] = int(self._look(np.array([pair[0]]), np.array([pair[1]]))[0])
            if known[pair] < NONE:
                heapq.heappush(heap, (known[pair], i, *pair))

        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = nxt[i]
            if dead[i] or j >= n or parts[i] != a or parts[j] != b:
                continue
            parts[i] = int(self.merged[rank])
            dead[j], nxt[i] = True, nxt[j]
            if nxt[j] < n:
                prev[nxt[j]] = i
                offer(i, nxt[j])
            if prev[i] >= 0:
                offer(prev[i], i)
        return [p for p, gone in zip(parts, dead) if not gone]

    def pieces(self, data: np.ndarray, begin: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the pieces ``begin .. stop`` end to end, and where each piece begins among them."""
        length = stop - begin
        ids: list[np.ndarray] = []
        where = np.zeros(len(begin), dtype=np.int64)
        many = np.zeros(len(begin), dtype=np.int64)
        filled = 0
        order = np.argsort(length, kind="stable")
        widths, first = np.unique(length[order], return_index=True)
        for width, rows in zip(widths.tolist(), np.split(order, first[1:])):
            if width > SHORT:
                for row in rows.tolist():
                    got = np.array(self._merge_long(self.first[data[begin[row]:stop[row]]].tolist()), dtype=np.int32)
                    where[row], many[row] = filled, len(got)
                    ids.append(got)
                    filled += len(got)
                continue
            for part in np.array_split(rows, -(-len(rows) * width // 300_000)):
                spread = begin[part][:, None] + np.arange(width)
                parts, count = self._merge_rows(data[spread])
                kept = np.arange(width) < count[:, None]
                got = parts[kept]
                where[part] = filled + np.cumsum(count) - count
                many[part] = count
                ids.append(got)
                filled += len(got)
        return (np.concatenate(ids) if ids else np.zeros(0, np.int32)), np.stack([where, many])

    # texts

    def encode_block(self, data: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a block end to end, and the offsets of the texts among them."""
        begin = self.cut(data, start)
        if not len(begin):
            return np.zeros(0, np.int32), np.zeros(len(start), np.int64)
        stop = np.append(begin[1:], len(data))
        # equal pieces are found by their bytes; they are numbered by first place
        offsets = np.append(begin, len(data)).astype(np.int64)
        each = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(begin), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])
        same = each.dictionary_encode().indices.to_numpy(zero_copy_only=False)
        one = np.empty(same.max() + 1, dtype=np.int64)
        one[same[::-1]] = np.arange(len(same))[::-1]
        ids, (where, many) = self.pieces(data, begin[one], stop[one])
        flat = ids[ranges(where[same], many[same])]
        done = np.concatenate([[0], np.cumsum(many[same])])
        return flat, done[np.searchsorted(begin, start)]

    def encode_texts(self, data: np.ndarray, start: np.ndarray) -> Iterator[np.ndarray]:
        """Ids of each text; the strings of added tokens become their ids."""
        hit = [s for s in self.special if data.tobytes().find(s.encode()) >= 0]
        if not hit:
            ids, at = self.encode_block(data, start)
            yield from (ids[a:b] for a, b in zip(at[:-1], at[1:]))
            return
        import re

        marks = re.compile(b"|".join(re.escape(s.encode()) for s in sorted(self.special, key=len, reverse=True)))
        for a, b in zip(start[:-1], start[1:]):
            text, out, last = data[a:b].tobytes(), [], 0
            spans = [*((m.start(), m.end()) for m in marks.finditer(text)), (len(text), len(text))]
            for lo, hi in spans:
                piece = np.frombuffer(text[last:lo], dtype=np.uint8)
                out.append(self.encode_block(piece, np.array([0, len(piece)]))[0])
                if hi > lo:
                    out.append(np.array([self.special[text[lo:hi].decode()]], dtype=np.int32))
                last = hi
            yield np.concatenate(out)

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


_codecs: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """One codec per vocabulary and worker process."""
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


def encode(docs: DataFrame, path: str, with_ids: bool = False) -> DataFrame:
    """Encode and decode every whole text: ``doc_id, n_tokens, ids_sha256, decoded_sha256`` (and ``ids``).

    NULL texts count as empty: no ids, and the digests of the empty string.  Every row
    gives one row, so repeated rows and missing ids stay as they are.  ``path`` must name
    the vocabulary on every executor.  Other columns of ``docs`` are not looked at.
    """
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if with_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(path)
        sha, name = hashlib.sha256, bpe.text_of.__getitem__
        for batch in batches:
            for block in blocks(batch.column(1)):
                n, ids_sha, text_sha, kept = [], [], [], []
                for ids in bpe.encode_texts(block.data, block.start):
                    flat = ids.tolist()
                    n.append(len(flat))
                    ids_sha.append(sha(",".join(map(name, flat)).encode()).hexdigest())
                    text_sha.append(sha(bpe.decode(flat).encode()).hexdigest())
                    if with_ids:
                        kept.append(ids)
                columns = [batch.column(0)[block.rows], pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if with_ids:
                    at = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
                    columns.append(pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate(kept))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)
