"""Token ids as flat unsigned integer files with 64-bit document offsets (operator 9).

A corpus folder holds, for each part of the ascending doc_id order,

    part-N.bin   ids one after another, little-endian unsigned integers of the index's width
    part-N.off   int64: n_docs + 1 offsets, in ids from the start of the part
    part-N.doc   int64: doc_ids (a null doc_id is the smallest int64)

and index.json: the width and, per part, documents, ids and base. Bases come from prefix sums of
the parts' id counts, so parts are written independently; a document is found from its part's
base and offsets, and files are memory-mapped, never read whole. Each task writes under a name of
its own and renames, so retried or duplicated tasks leave the same files.
"""

from __future__ import annotations

import json
import re
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlytics.llm.bpe import distinct_pieces, gather
from adlytics.llm.common import ordered_bucket, per_worker, shared_folder, shuffle_partitions
from adlytics.llm.textvec import blocks, buffers, plain_strings, space_table

BLOCK = 8 << 20          # bytes of text encoded at a time
END_ID = 1
PARTS_PER_TASK = 2
POOL = 300_000           # pieces remembered from block to block; the pool starts anew beyond
JOIN = 2000              # pieces per call of the tokenizer
MARK = "\x01"            # stands between pieces in a call; pieces that hold it are encoded alone
NULL_ID = -(1 << 63)


class PieceTokenizer:
    """Ids of a ``tokenizers`` library file whose pre-tokens never hold white space.

    The tokenizer lower-cases and splits at white space and between letters and punctuation, so a
    text's ids are its pieces' ids one after another. Pieces end at ASCII white space and where
    an ASCII letter or digit meets ASCII punctuation other than an apostrophe; each distinct
    piece (ASCII letters lower-cased) is encoded by the library once. With ``added``, a string of
    an added token in a text is that token, as by the library's defaults; without, such strings
    are ordinary text.
    """

    def __init__(self, path: str, added: bool = False):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True        # pieces are ordinary text
        self.added = {}                                    # string of an added token: its id
        for i, t in self.tokenizer.get_added_tokens_decoder().items() if added else ():
            if t.normalized or t.lstrip or t.rstrip or t.single_word:
                raise ValueError(f"added token {t.content!r} is not matched as it stands in the text")
            self.added[t.content.encode()] = i
        # As the library takes them: the leftmost, and of those the longest.
        self.find = re.compile(b"|".join(map(re.escape, sorted(self.added, key=len, reverse=True))))
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        mark = self.ids([MARK])[0]
        self.mark = mark[0] if len(mark) == 1 else None
        self.width = 2 if self.tokenizer.get_vocab_size(True) <= 1 << 16 else 4
        kind = np.zeros(256, np.uint8)                     # 1 letter or digit, 2 punctuation
        for i in range(33, 127):
            kind[i] = 1 if chr(i).isalnum() else 2
        kind[ord("'")] = 0
        self.kind = kind
        lower = np.arange(256, dtype=np.uint8)
        lower[ord("A"):ord("Z") + 1] += 32
        self.lower = lower
        self.clear()

    def ids(self, texts):
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def clear(self):
        self.known, self.pool, self.counts = {}, np.zeros(0, np.int32), np.zeros(0, np.int64)

    def piece_ids(self, pieces):
        """(ids, counts) of pieces, many per call with a mark between."""
        plain = [p for p in pieces if self.mark is not None and MARK not in p]
        if len(plain) < len(pieces):
            each = self.ids(pieces)
            counts = np.array([len(x) for x in each], np.int64)
            return np.array([i for x in each for i in x], np.int32), counts
        groups = [plain[i:i + JOIN] for i in range(0, len(plain), JOIN)]
        ids, counts = [], []
        for group, found in zip(groups, self.ids([f" {MARK} ".join(g + [""]) for g in groups])):
            flat = np.array(found, np.int32)
            ends = np.flatnonzero(flat == self.mark)
            counts.append(np.diff(ends, prepend=-1) - 1)
            ids.append(flat[flat != self.mark])
        return np.concatenate(ids), np.concatenate(counts)

    def added_spans(self, d, off):
        """(starts, ends, ids) of the added tokens' strings in the texts."""
        raw = d.tobytes() if self.added else b""
        if not any(t in raw for t in self.added):
            return np.zeros((3, 0), np.int64)
        found = [(m.start(), m.end(), self.added[m.group()]) for i, j in zip(off[:-1].tolist(), off[1:].tolist())
                 for m in self.find.finditer(raw, i, j)]
        return np.array(found, np.int64).reshape(-1, 3).T

    def encode(self, a: pa.Array):
        """(ids, ids per text) of a block of texts."""
        d, off = buffers(a)
        if not len(d):
            return np.zeros(0, np.int32), np.zeros(len(a), np.int64)
        first, last, token = self.added_spans(d, off)
        d = self.lower[d]
        white, kind = space_table()[d], self.kind[d]
        cut = white.copy()                                  # a piece starts with its white space
        cut[1:] &= ~white[:-1]
        cut[1:] |= (kind[1:] != kind[:-1]) & (kind[1:] > 0) & (kind[:-1] > 0)
        cut[off[:-1][off[:-1] < off[1:]]] = True
        for i, j in zip(first, last):                       # an added token's string is one piece
            cut[i:j] = False
        cut[first] = True
        cut[last[last < len(d)]] = True
        starts = np.flatnonzero(cut)
        distinct, number, per_text = distinct_pieces(d, off, starts)
        if len(self.known) > POOL:
            self.clear()
        names = [p.lstrip(" \t\n\v\f\r") for p in distinct]
        new = list(dict.fromkeys(p for p in names if p not in self.known))
        if new:
            ids, counts = self.piece_ids(new)
            for p in new:
                self.known[p] = len(self.known)
            self.pool, self.counts = np.concatenate([self.pool, ids]), np.concatenate([self.counts, counts])
        place = np.array([self.known[p] for p in names], np.int64)[number]
        if not len(token):
            return gather(self.pool, self.counts, place, per_text)
        kinds, which = np.unique(token, return_inverse=True)
        place[np.searchsorted(starts, first)] = len(self.counts) + which
        return gather(np.concatenate([self.pool, kinds.astype(np.int32)]),
                      np.concatenate([self.counts, np.ones(len(kinds), np.int64)]), place, per_text)


def encoded(docs: DataFrame, path: str, end_id: int | None = END_ID) -> DataFrame:
    """(doc_id, n, ids): ids of the whole text (null: empty) and the end id, as packed bytes."""
    def run(batches):
        tok = per_worker(("pieces", path), lambda: PieceTokenizer(path, added=True))
        kind = np.dtype(f"<u{tok.width}")
        for batch in batches:
            texts = plain_strings(batch.column("text"))
            for i, j in blocks(texts, BLOCK):
                ids, counts = tok.encode(texts[i:j])
                if end_id is not None:
                    ids = np.insert(ids, np.cumsum(counts), end_id)
                    counts = counts + 1
                raw = ids.astype(kind).tobytes()
                ends = np.cumsum(counts) * tok.width
                lists = pa.Array.from_buffers(pa.binary(), j - i, [
                    None, pa.py_buffer(np.concatenate([[0], ends]).astype(np.int32)), pa.py_buffer(raw)])
                yield pa.RecordBatch.from_arrays([batch.column("doc_id")[i:j], pa.array(counts), lists],
                                                 names=["doc_id", "n", "ids"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, n long, ids binary")


def width_of(path: str) -> int:
    from tokenizers import Tokenizer
    return 2 if Tokenizer.from_file(path).get_vocab_size(True) <= 1 << 16 else 4


def folder_of(uri: str):
    return fs.FileSystem.from_uri(uri)


def write_corpus(docs: DataFrame, tokenizer: str, folder: str, end_id: int | None = END_ID) -> dict:
    """Write the ids of ``docs`` (doc_id, text) in ascending doc_id order (nulls first, equal ids
    by their ids' bytes); returns the index. Whole texts are not shuffled, only packed ids."""
    spark = docs.sparkSession
    parts = shuffle_partitions(spark)
    bucket = ordered_bucket(docs.select(F.col("doc_id").cast("long").alias("doc_id")), "doc_id", parts * PARTS_PER_TASK)
    width = width_of(tokenizer)
    rows = encoded(docs, tokenizer, end_id).withColumn("bucket", bucket) \
        .repartition(parts, "bucket").sortWithinPartitions("bucket", F.col("doc_id").asc_nulls_first(), "ids")

    def write(batches):
        where, root = folder_of(folder)
        where.create_dir(root, recursive=True)
        state = None

        def close():
            number, stem, out, offsets, ids = state
            out.close()
            for name, values in (("off", [0, *offsets]), ("doc", ids)):
                with where.open_output_stream(f"{stem}.{name}") as f:
                    f.write(np.array(values, "<i8").tobytes())
            for name in ("bin", "off", "doc"):
                where.move(f"{stem}.{name}", f"{root}/part-{number}.{name}")
            return pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), pa.array([len(ids)], pa.int64()),
                                               pa.array([offsets[-1]], pa.int64())], names=["part", "n_docs", "n_ids"])

        for batch in batches:
            numbers, ids = batch.column("bucket").to_pylist(), batch.column("doc_id").to_pylist()
            for k, number in enumerate(numbers):
                if state is None or state[0] != number:
                    if state is not None:
                        yield close()
                    stem = f"{root}/.{uuid.uuid4().hex}"
                    state = number, stem, where.open_output_stream(f"{stem}.bin"), [], []
                raw = batch.column("ids")[k].as_buffer()
                state[2].write(raw)
                state[3].append((state[3][-1] if state[3] else 0) + raw.size // width)
                state[4].append(NULL_ID if ids[k] is None else ids[k])
        if state is not None:
            yield close()

    # One row per part: what the index holds.
    found = sorted(rows.select("bucket", "doc_id", "ids").mapInArrow(
        write, "part int, n_docs long, n_ids long").collect())
    index, base, docs_before = {"width": width, "parts": []}, 0, 0
    for r in found:
        index["parts"].append({"part": r.part, "n_docs": r.n_docs, "n_ids": r.n_ids, "base": base, "first": docs_before})
        base, docs_before = base + r.n_ids, docs_before + r.n_docs
    where, root = folder_of(folder)
    where.create_dir(root, recursive=True)
    with where.open_output_stream(f"{root}/index.json") as f:
        f.write(json.dumps(index).encode())
    return index


def read_index(folder: str) -> dict:
    where, root = folder_of(folder)
    with where.open_input_stream(f"{root}/index.json") as f:
        return json.loads(f.read())


def mapped(where, path: str, kind: str) -> np.ndarray:
    """A file's integers: memory-mapped if local, else read from the store."""
    if not where.get_file_info(path).size:
        return np.zeros(0, kind)
    if isinstance(where, fs.LocalFileSystem):
        return np.memmap(path, kind, "r")
    with where.open_input_file(path) as f:
        return np.frombuffer(f.read_buffer(), kind)


def read_slice(folder: str, start: int, count: int) -> np.ndarray:
    """``count`` ids from position ``start`` of the whole corpus, over part borders."""
    index, (where, root) = read_index(folder), folder_of(folder)
    out = []
    for p in index["parts"]:
        lo, hi = max(start, p["base"]), min(start + count, p["base"] + p["n_ids"])
        if lo < hi:
            ids = mapped(where, f"{root}/part-{p['part']}.bin", f"<u{index['width']}")
            out.append(np.array(ids[lo - p["base"]:hi - p["base"]]))
    return np.concatenate(out) if out else np.zeros(0, f"<u{index['width']}")


def read_corpus(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) per document, from the files: one task reads
    a part's documents through its offsets."""
    index = read_index(folder)
    width, step = index["width"], 4096
    parts = spark.createDataFrame([(p["part"], p["base"]) for p in index["parts"]], "part int, base long")

    def read(batches):
        where, root = folder_of(folder)
        for batch in batches:
            for number, base in zip(batch.column("part").to_pylist(), batch.column("base").to_pylist()):
                ids = mapped(where, f"{root}/part-{number}.bin", f"<u{width}")
                off = mapped(where, f"{root}/part-{number}.off", "<i8")
                doc = mapped(where, f"{root}/part-{number}.doc", "<i8")
                for i in range(0, len(doc), step):
                    j = min(i + step, len(doc))
                    o = np.array(off[i:j + 1])
                    own = [np.asarray(ids[a:b]).astype("<u4") for a, b in zip(o[:-1], o[1:])]
                    own_doc = np.array(doc[i:j])
                    yield pa.RecordBatch.from_arrays([
                        pa.array(own_doc, mask=own_doc == NULL_ID), pa.array(base + o[:-1]), pa.array(np.diff(o)),
                        pa.array([zlib.crc32(x.tobytes()) for x in own], pa.int64())],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"])

    n = max(1, min(len(index["parts"]), shuffle_partitions(spark)))
    return parts.repartition(n, "part").mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, tokenizer: str, end_id: int | None = END_ID) -> DataFrame:
    """Write ``docs`` to a fresh corpus folder under spark.checkpoint.dir and read it back."""
    folder = shared_folder(docs.sparkSession, "flat-corpus")
    write_corpus(docs, tokenizer, folder, end_id)
    return read_corpus(docs.sparkSession, folder)
