"""Byte-level BPE by rank files (operator 10): encode whole texts, decode ids.

Texts are cut before each run of white space; a piece (white space and what follows) splits into
pre-tokens the same way wherever it stands, so each distinct piece of a block of texts is split,
and each distinct pre-token merged, once. Pieces are remembered from block to block, in a pool
of bounded size. Blocks with white space outside ASCII are split text by text.

All distinct pre-tokens of a block are merged together by one rank queue over one doubly linked
list of their bytes. The queue has a bucket of list positions for each merge rank and a
hierarchical bitmap (64-way, three levels) over the ranks with a non-empty bucket; find-first-set
gives the next rank. A bucket's entries are taken in text order; an entry is stale, and skipped,
if its pair no longer has the bucket's rank. Merging one rank at all its places in all pre-tokens
is the same as the merge loop of each pre-token by itself, since pre-tokens never touch. Work is
proportional to the number of merges, however long a pre-token is.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlytics.llm.common import per_worker
from adlytics.llm.textvec import blocks, buffers, plain_strings, space_table

BLOCK = 2 << 20          # bytes of text encoded at a time
POOL = 400_000           # pieces remembered from block to block; the pool starts anew beyond
# Fixed value: white space as the rank files' library sees it (Unicode White_Space).
WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def splitter(pattern: str):
    """The pre-token pattern with white space spelled out, so that it means the same here."""
    return regex.compile(pattern.replace(r"[^\s\p{L}\p{N}]", rf"[^{WHITE}\p{{L}}\p{{N}}]")
                         .replace(r"\s", f"[{WHITE}]").replace(r"\S", f"[^{WHITE}]"))


class RankBitmap:
    """The set of ranks with a non-empty bucket; the smallest by find-first-set."""

    def __init__(self, n: int):
        self.levels = []
        while True:
            n = (n + 63) // 64
            self.levels.append([0] * max(n, 1))
            if n <= 1:
                break

    def add(self, x: int) -> None:
        for words in self.levels:
            old = words[x >> 6]
            words[x >> 6] = old | 1 << (x & 63)
            if old:
                return
            x >>= 6

    def remove(self, x: int) -> None:
        for words in self.levels:
            words[x >> 6] &= ~(1 << (x & 63))
            if words[x >> 6]:
                return
            x >>= 6

    def first(self) -> int:
        """The smallest rank, or -1."""
        if not self.levels[-1][0]:
            return -1
        x = 0
        for words in reversed(self.levels):
            w = words[x]
            x = x << 6 | ((w & -w).bit_length() - 1)
        return x


class Bpe:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.split = splitter(pattern)
        self.n = max(ranks.values()) + 1
        self.bytes = [b""] * self.n
        for token, r in ranks.items():
            self.bytes[r] = token
        self.byte_id = np.array([ranks[bytes([i])] for i in range(256)], np.int64)
        left, right, merged = [], [], []
        for token, r in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    left.append(a), right.append(b), merged.append(r)
        pair = np.array(left, np.int64) * self.n + np.array(right, np.int64)
        order = np.argsort(pair)
        # sentinels, so that a search always finds a place
        self.pair = np.concatenate([pair[order], [np.iinfo(np.int64).max]])
        self.rank = np.concatenate([np.array(merged, np.int64)[order], [self.n]])
        self.text = [str(i).encode() for i in range(self.n)]
        self.clear()

    def rank_of(self, a, b):
        """Rank of the token that two adjacent tokens make, or n."""
        key = a * self.n + b
        at = np.searchsorted(self.pair, key)
        return np.where(self.pair[at] == key, self.rank[at], self.n)

    def merge(self, tokens: list[bytes]):
        """(ids, counts): the ids of all tokens one after another, and how many each has."""
        lengths = np.array([len(t) for t in tokens], np.int64)
        raw = np.frombuffer(b"".join(tokens), np.uint8)
        size = len(raw)
        if not size:
            return np.zeros(0, np.int64), np.zeros(len(tokens), np.int64)
        ids = self.byte_id[raw]
        nxt, prv = np.arange(1, size + 1), np.arange(-1, size - 1)
        ends = np.cumsum(lengths)
        nxt[ends[lengths > 0] - 1] = -1
        prv[(ends - lengths)[lengths > 0]] = -1
        alive = np.ones(size, bool)
        rank = np.full(size, self.n)          # of the pair that begins here, as it now stands
        at = np.flatnonzero(nxt >= 0)
        rank[at] = self.rank_of(ids[at], ids[nxt[at]])
        at = at[rank[at] < self.n]
        at = at[np.argsort(rank[at], kind="stable")]
        buckets: dict[int, list] = {}
        queue = RankBitmap(self.n)
        if len(at):
            cut = np.flatnonzero(np.diff(rank[at])) + 1
            for part in np.split(at, cut):
                r = int(rank[part[0]])
                buckets[r] = [part]
                queue.add(r)
        while (r := queue.first()) >= 0:
            queue.remove(r)
            entries = buckets.pop(r)
            at = entries[0] if len(entries) == 1 else np.sort(np.concatenate(entries))
            at = at[(rank[at] == r) & alive[at]]
            if len(at) > 1:
                at = at[np.concatenate([[True], at[1:] != at[:-1]])]
                at = self.disjoint(at, nxt)
            if not len(at):
                continue
            gone = nxt[at]
            after = nxt[gone]
            ids[at] = r
            alive[gone] = False
            rank[gone] = self.n
            nxt[at] = after
            has = after >= 0
            prv[after[has]] = at[has]
            before = prv[at]
            before = before[before >= 0]
            changed = np.concatenate([at, before])
            follow = nxt[changed]
            new = np.full(len(changed), self.n)
            ok = follow >= 0
            new[ok] = self.rank_of(ids[changed[ok]], ids[follow[ok]])
            rank[changed] = new
            live = new < self.n
            changed, new = changed[live], new[live]
            if len(changed):
                order = np.argsort(new, kind="stable")
                changed, new = changed[order], new[order]
                cut = np.flatnonzero(np.diff(new)) + 1
                for part, q in zip(np.split(changed, cut), new[np.concatenate([[0], cut])].tolist()):
                    if q in buckets:
                        buckets[q].append(part)
                    else:
                        buckets[q] = [part]
                        queue.add(q)
        owner = np.repeat(np.arange(len(tokens)), lengths)
        return ids[alive], np.bincount(owner[alive], minlength=len(tokens))

    @staticmethod
    def disjoint(at, nxt):
        """Of positions whose pairs overlap the one before (a run like 'aaaa'), every other."""
        touch = np.concatenate([[False], nxt[at[:-1]] == at[1:]])
        if not touch.any():
            return at
        place = np.arange(len(at))
        start = np.maximum.accumulate(np.where(touch, 0, place))
        return at[(place - start) % 2 == 0]

    def pieces(self, a: pa.Array):
        """(distinct pieces, piece number of every piece, pieces per text) of a block of texts."""
        d, off = buffers(a)
        if not len(d):
            return [], np.zeros(0, np.int64), np.zeros(len(a), np.int64)
        white = space_table()[d]
        cut = white.copy()
        cut[1:] &= ~white[:-1]
        cut[off[:-1][off[:-1] < off[1:]]] = True
        return distinct_pieces(d, off, np.flatnonzero(cut))

    def piece_ids(self, pieces: list[str]):
        """(ids, counts) of pieces: each is split by the pattern, each distinct pre-token merged.

        Pieces that begin with white space and go on split the same way one after another, so
        they are split by one call.
        """
        joint = [bool(p) and p[0] in " \t\n\v\f\r" and not p.isspace() for p in pieces]
        found = self.split.findall("".join([p for p, j in zip(pieces, joint) if j]))
        ends = np.cumsum([len(p) for p, j in zip(pieces, joint) if j])
        n = np.diff(np.searchsorted(np.cumsum([len(t) for t in found]), ends, side="right"), prepend=0)
        alone = [self.split.findall(p) for p, j in zip(pieces, joint) if not j]
        per_piece, joint = np.zeros(len(pieces), np.int64), np.array(joint, bool)
        per_piece[joint] = n
        per_piece[~joint] = [len(x) for x in alone]
        order = np.argsort(np.concatenate([np.flatnonzero(joint), np.flatnonzero(~joint)]), kind="stable")
        coded = pc.dictionary_encode(pa.array(found + [t for x in alone for t in x], pa.large_string()))
        ids, counts = self.merge([t.encode() for t in coded.dictionary.to_pylist()])
        n = np.concatenate([per_piece[joint], per_piece[~joint]])
        ids, counts = gather(ids, counts, coded.indices.to_numpy().astype(np.int64), n)
        return gather(ids, counts, order, np.ones(len(order), np.int64))

    def coded(self, a: pa.Array):
        """(pool number of every piece, pieces per text); unknown pieces are added to the pool."""
        distinct, number, per_text = self.pieces(a)
        if len(self.known) > POOL:
            self.clear()
        new = [p for p in distinct if p not in self.known]
        if new:
            ids, counts = self.piece_ids(new)
            for p in new:
                self.known[p] = len(self.known)
            self.pool = np.concatenate([self.pool, ids.astype(np.int32)])
            self.counts = np.concatenate([self.counts, counts])
        place = np.array([self.known[p] for p in distinct], np.int64)
        return place[number], per_text

    def clear(self):
        self.known: dict[str, int] = {}
        self.pool, self.counts = np.zeros(0, np.int32), np.zeros(0, np.int64)

    def encode(self, a: pa.Array):
        """(ids, ids per text) of a block of texts."""
        if self.odd_texts(a):
            return self.encode_whole(a)
        number, per_text = self.coded(a)
        return gather(self.pool, self.counts, number, per_text)

    def lengths(self, a: pa.Array):
        """Ids per text, without the ids."""
        if self.odd_texts(a):
            return self.encode_whole(a)[1]
        number, per_text = self.coded(a)
        ends = np.cumsum(per_text)
        total = np.concatenate([[0], np.cumsum(self.counts[number])])
        return total[ends] - total[ends - per_text]

    def odd_texts(self, a: pa.Array):
        """Whether a text has white space outside ASCII, where pieces could split a run."""
        found = pc.match_substring_regex(a, r"[\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]")
        return bool(pc.any(found).as_py())

    def encode_whole(self, a: pa.Array):
        """As ``encode``, each text split as a whole."""
        known: dict[str, int] = {}
        token_of, per_text = [], np.zeros(len(a), np.int64)
        for i, text in enumerate(a.to_pylist()):
            found = self.split.findall(text)
            per_text[i] = len(found)
            token_of.extend(known.setdefault(t, len(known)) for t in found)
        ids, counts = self.merge([t.encode() for t in known])
        return gather(ids, counts, np.array(token_of, np.int64), per_text)

    def decode(self, ids) -> bytes:
        table = self.bytes
        return b"".join([table[i] for i in ids])


def distinct_pieces(d, off, starts):
    """(distinct strings, number of each piece among them, pieces per text) of bytes cut at ``starts``."""
    per_text = np.diff(np.searchsorted(starts, off))
    offsets = np.append(starts, len(d)).astype(np.int64)
    words = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(d)])
    coded = pc.dictionary_encode(words)
    return coded.dictionary.to_pylist(), coded.indices.to_numpy().astype(np.int64), per_text


def gather(values, counts, number, per_group):
    """Lists (values split by counts) picked by ``number``, joined in groups of ``per_group``."""
    start = np.cumsum(counts) - counts
    n = counts[number]
    total = int(n.sum())
    at = np.arange(total) - np.repeat(np.cumsum(n) - n, n) + np.repeat(start[number], n)
    ends = np.concatenate([[0], np.cumsum(n)])[np.cumsum(per_group)] if len(per_group) else np.zeros(0, np.int64)
    return values[at], np.diff(np.concatenate([[0], ends]))


def encode_table(df: DataFrame, path: str, pattern: str, text: str = "text", out: str = "ids") -> DataFrame:
    """``df`` with a column of ids (array<int>) of its text column (null: empty text)."""
    from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType
    schema = StructType([f for f in df.schema.fields if f.name != out]
                        + [StructField(out, ArrayType(IntegerType()), False)])
    at = df.columns.index(text)
    keep = [i for i, c in enumerate(df.columns) if c != out]

    def encode(batches):
        bpe = per_worker(("bpe", path, pattern), lambda: Bpe(read_ranks(path), pattern))
        for batch in batches:
            texts = plain_strings(batch.column(at))
            for i, j in blocks(texts, BLOCK):
                ids, counts = bpe.encode(texts[i:j])
                off = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
                lists = pa.ListArray.from_arrays(off, pa.array(ids.astype(np.int32)))
                part = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays([part.column(k) for k in keep] + [lists], names=schema.names)

    return df.mapInArrow(encode, schema)


def decode_table(df: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with the decoded bytes (binary) of its ids."""
    from pyspark.sql.types import BinaryType, StructField, StructType
    schema = StructType([f for f in df.schema.fields if f.name != out] + [StructField(out, BinaryType(), False)])
    tokens = {r: t for t, r in read_ranks(path).items()}
    at = df.columns.index(ids)
    keep = [i for i, c in enumerate(df.columns) if c != out]

    def decode(batches):
        for batch in batches:
            lists = batch.column(at)
            raw = [b"".join([tokens[i] for i in lists[k].values.to_pylist()]) for k in range(len(lists))]
            yield pa.RecordBatch.from_arrays([batch.column(k) for k in keep] + [pa.array(raw, pa.binary())],
                                             names=schema.names)

    return df.mapInArrow(decode, schema)


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): encode, decode the ids, digest both."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def run(batches):
        bpe = per_worker(("bpe", path, pattern), lambda: Bpe(read_ranks(path), pattern))
        for batch in batches:
            texts = plain_strings(batch.column("text"))
            for i, j in blocks(texts, BLOCK):
                ids, counts = bpe.encode(texts[i:j])
                ends = np.cumsum(counts)
                id_sha, raw_sha = [], []
                for a, b in zip((ends - counts).tolist(), ends.tolist()):
                    own = ids[a:b].tolist()
                    id_sha.append(hashlib.sha256(b",".join([bpe.text[x] for x in own])).hexdigest())
                    raw_sha.append(hashlib.sha256(bpe.decode(own)).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id")[i:j], pa.array(counts), pa.array(id_sha), pa.array(raw_sha)],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
