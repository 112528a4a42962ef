"""Fill-in-the-middle over texts stored as seekable compressed frames (operator 13).

A text is stored as independent zstandard frames of at most ``FRAME`` bytes, cut between code
points, with the number of units and of code points before each frame. A unit is a run of
letters A-Z, a-z or any other code point, `[A-Za-z]+|[^A-Za-z]`; a run that goes on into the next
frame counts where it starts, and the next frame is marked as joined.

The text is split behind a number of units. The place of a cut is found from the counts, and only
the frame that holds it is decompressed for it. The output is streamed, frame by frame in the
order of its form, into frames of its own; digests and the rebuilt text are streamed from those.
So no more than a few frames of a text are decompressed at a time.

Forms: plain (the text); psm, `<P>`prefix`<S>`suffix`<M>`middle; spm,
`<S>`suffix`<P>`prefix`<M>`middle. A text that holds a marker stays plain, so each marker of
the other forms occurs once, and prefix, middle and suffix follow from the output alone.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlytics.llm.common import shared_folder
from adlytics.llm.textvec import blocks, plain_strings

# The markers, and the shares in percent of texts that are split and, of those, in spm.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SPLIT_PERCENT, SPM_PERCENT = 90, 20
FRAME = 1 << 16
LEVEL = 3
FRAMES = "array<struct<data:binary,units:bigint,chars:bigint,joined:boolean>>"
_FRAME_TYPE = pa.struct([("data", pa.binary()), ("units", pa.int64()), ("chars", pa.int64()), ("joined", pa.bool_())])


def letter_table() -> np.ndarray:
    t = np.zeros(256, bool)
    t[ord("A"):ord("Z") + 1] = t[ord("a"):ord("z") + 1] = True
    return t


class FrameWriter:
    """Takes bytes of one text in order and keeps them as compressed frames."""

    def __init__(self, codec, letters, frame: int = FRAME):
        self.codec, self.letters, self.frame = codec, letters, frame
        self.frames: list[tuple[bytes, int, int, bool]] = []
        self.units = self.chars = 0
        self.in_run = False
        self.held = b""

    def write(self, piece: bytes):
        self.held = self.held + piece if self.held else piece
        at = 0
        while len(self.held) - at > self.frame:
            stop = at + self.frame
            while stop > at + 1 and self.held[stop] & 0xC0 == 0x80:     # never inside a code point
                stop -= 1
            self._close(self.held[at:stop])
            at = stop
        self.held = self.held[at:]

    def _close(self, data: bytes):
        d = np.frombuffer(data, np.uint8)
        start = unit_starts(d, self.letters, self.in_run)
        joined = bool(self.in_run and self.letters[d[0]])
        self.frames.append((self.codec.compress(data), self.units, self.chars, joined))
        self.units += int(start.sum())
        self.chars += int(((d & 0xC0) != 0x80).sum())
        self.in_run = bool(self.letters[d[-1]])

    def finish(self):
        """(frames, units, code points) of the whole text; an empty text has no frames."""
        if self.held:
            self._close(self.held)
            self.held = b""
        return self.frames, self.units, self.chars


def unit_starts(d: np.ndarray, letters: np.ndarray, in_run: bool) -> np.ndarray:
    """Marks the bytes at which units start; ``in_run``: the byte before ``d`` is a letter."""
    letter = letters[d]
    start = (d & 0xC0) != 0x80
    start[1:] &= ~(letter[1:] & letter[:-1])
    start[0] &= not (in_run and letter[0])
    return start


class FrameReader:
    """Reads parts of a text from its frames, one frame at a time."""

    def __init__(self, frames, codec, letters):
        self.data = [f["data"] for f in frames]
        self.units = [f["units"] for f in frames]
        self.chars = [f["chars"] for f in frames]
        self.joined = [f["joined"] for f in frames]
        self.codec, self.letters = codec, letters
        self.offset = [0]                               # in bytes of text, from the frames' headers
        for x in self.data:
            self.offset.append(self.offset[-1] + zstandard.frame_content_size(x))
        self.last = (-1, b"")

    def frame(self, i: int) -> bytes:
        if self.last[0] != i:
            self.last = (i, self.codec.decompress(self.data[i]))
        return self.last[1]

    def place(self, unit: int, n_units: int, n_chars: int) -> tuple[int, int]:
        """(byte, code point) at which unit number ``unit`` starts; the end for ``n_units``."""
        if unit >= n_units:
            return self.offset[-1], n_chars
        i = bisect_right(self.units, unit) - 1
        d = np.frombuffer(self.frame(i), np.uint8)
        at = int(np.flatnonzero(unit_starts(d, self.letters, self.joined[i]))[unit - self.units[i]])
        return self.offset[i] + at, self.chars[i] + int(((d[:at] & 0xC0) != 0x80).sum())

    def stream(self, start: int, stop: int):
        """The bytes from ``start`` up to ``stop``, frame by frame."""
        i = max(bisect_right(self.offset, start) - 1, 0)
        while i < len(self.data) and self.offset[i] < stop:
            lo, hi = max(start - self.offset[i], 0), stop - self.offset[i]
            if lo < hi:
                yield self.frame(i)[lo:hi]
            i += 1

    def find(self, marker: bytes, start: int) -> int:
        """The first byte of ``marker`` at or after ``start``, across frames."""
        tail, at = b"", start
        for piece in self.stream(start, self.offset[-1]):
            hit = (tail + piece).find(marker)
            if hit >= 0:
                return at - len(tail) + hit
            at += len(piece)
            tail = (tail + piece)[1 - len(marker):]
        raise ValueError(f"no {marker!r} in the text")


def frame_column(rows: list[list[tuple]]) -> pa.ListArray:
    off = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
    flat = [f for r in rows for f in r]
    parts = [pa.array([f[k] for f in flat], t.type) for k, t in enumerate(_FRAME_TYPE)]
    return pa.ListArray.from_arrays(pa.array(off), pa.StructArray.from_arrays(parts, [t.name for t in _FRAME_TYPE]))


def framed(docs: DataFrame, frame: int = FRAME) -> DataFrame:
    """(doc_id, n_units, n_chars, marked, frames) per row of ``docs`` (doc_id, text).

    ``marked``: the text holds one of the markers. A null text is empty, without frames. Null
    ids, repeated rows and an empty table are taken as they come; other columns are not read.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def run(batches):
        codec, letters = zstandard.ZstdCompressor(level=LEVEL), letter_table()
        for batch in batches:
            texts = plain_strings(batch.column("text")).cast(pa.large_binary())
            for i, j in blocks(texts):
                frames, units, chars, marked = [], [], [], []
                for t in texts[i:j]:
                    text = t.as_py()
                    writer = FrameWriter(codec, letters, frame)
                    writer.write(text)
                    f, u, c = writer.finish()
                    frames.append(f)
                    units.append(u)
                    chars.append(c)
                    marked.append(any(m in text for m in (PREFIX, SUFFIX, MIDDLE)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id")[i:j], pa.array(units, pa.int64()), pa.array(chars, pa.int64()),
                     pa.array(marked, pa.bool_()), frame_column(frames)],
                    names=["doc_id", "n_units", "n_chars", "marked", "frames"])

    return rows.mapInArrow(run, f"doc_id long, n_units long, n_chars long, marked boolean, frames {FRAMES}")


def write_store(docs: DataFrame, folder: str) -> DataFrame:
    """Writes ``framed(docs)`` below ``folder`` (as it is: frames are compressed already) and reads it."""
    framed(docs).write.option("compression", "none").parquet(folder)
    return docs.sparkSession.read.parquet(folder)


def draws(doc_id) -> list[int]:
    """Four unsigned 32-bit numbers from the id; a null id counts as empty text."""
    x = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(x[k:k + 8], 16) for k in range(0, 32, 8)]


def fill_in_middle(store: DataFrame) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, frames): the outputs, as frames, of the texts
    of ``store``. Plain outputs have null lengths; an empty text is plain and has no frames."""
    def run(batches):
        pack, unpack, letters = zstandard.ZstdCompressor(level=LEVEL), zstandard.ZstdDecompressor(), letter_table()

        def split(row):
            n, n_chars = row["n_units"], row["n_chars"]
            h1, h2, h3, h4 = draws(row["doc_id"])
            if n == 0 or row["marked"] or h3 % 100 >= SPLIT_PERCENT:
                return "plain", None, None, [tuple(f.values()) for f in row["frames"]]
            form = "spm" if h4 % 100 < SPM_PERCENT else "psm"
            reader = FrameReader(row["frames"], unpack, letters)
            first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
            (a, a_chars), (b, b_chars) = (reader.place(k, n, n_chars) for k in (first, second))
            parts = {PREFIX: (0, a), SUFFIX: (b, reader.offset[-1]), MIDDLE: (a, b)}
            writer = FrameWriter(pack, letters)
            for marker in (SUFFIX, PREFIX, MIDDLE) if form == "spm" else (PREFIX, SUFFIX, MIDDLE):
                writer.write(marker)
                for piece in reader.stream(*parts[marker]):
                    writer.write(piece)
            return form, a_chars, b_chars - a_chars, writer.finish()[0]

        for batch in batches:
            for part in row_slices(batch):
                ids, n = part.column("doc_id"), part.column("n_units")
                out = [split(r) for r in part.to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [ids, n, pa.array([o[0] for o in out], pa.string()), pa.array([o[1] for o in out], pa.int64()),
                     pa.array([o[2] for o in out], pa.int64()), frame_column([o[3] for o in out])],
                    names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "frames"])

    return store.select("doc_id", "n_units", "n_chars", "marked", "frames").mapInArrow(
        run, f"doc_id long, n long, form string, prefix_chars long, middle_chars long, frames {FRAMES}")


def row_slices(batch: pa.RecordBatch, max_bytes: int = 1 << 20):
    """Cuts a batch with frames into slices of about ``max_bytes`` compressed bytes."""
    size = pc.binary_length(batch.column("frames").flatten().field("data")).to_numpy(zero_copy_only=False)
    per_row = pc.list_value_length(batch.column("frames")).to_numpy(zero_copy_only=False)
    total = np.concatenate([[0], np.cumsum(size)])[np.concatenate([[0], np.cumsum(per_row)])]
    i = 0
    while i < len(batch):
        j = max(int(np.searchsorted(total, total[i] + max_bytes, side="right")) - 1, i + 1)
        yield batch.slice(i, min(j, len(batch)) - i)
        i = j


def restored(reader: FrameReader, form: str):
    """The text's bytes, piece by piece, rebuilt from an output and its form."""
    end = reader.offset[-1]
    if form == "plain":
        yield from reader.stream(0, end)
        return
    order = (SUFFIX, PREFIX, MIDDLE) if form == "spm" else (PREFIX, SUFFIX, MIDDLE)
    at = {}
    place = 0
    for marker in order:
        at[marker] = reader.find(marker, place)
        place = at[marker] + len(marker)
    stop = dict(zip(order, [at[order[1]], at[order[2]], end]))
    for marker in (PREFIX, MIDDLE, SUFFIX):
        yield from reader.stream(at[marker] + len(marker), stop[marker])


def digests(outputs: DataFrame) -> DataFrame:
    """``outputs`` with output_sha256 and restored_sha256, streamed from the frames, in their place."""
    keep = [c for c in outputs.columns if c != "frames"]

    def run(batches):
        unpack, letters = zstandard.ZstdDecompressor(), letter_table()

        def of(row):
            reader = FrameReader(row["frames"], unpack, letters)
            out, back = hashlib.sha256(), hashlib.sha256()
            for piece in reader.stream(0, reader.offset[-1]):
                out.update(piece)
            for piece in restored(reader, row["form"]):
                back.update(piece)
            return out.hexdigest(), back.hexdigest()

        for batch in batches:
            for part in row_slices(batch):
                both = [of(r) for r in part.select(["form", "frames"]).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in keep), pa.array([x for x, _ in both], pa.string()),
                     pa.array([x for _, x in both], pa.string())], names=[*keep, "output_sha256", "restored_sha256"])

    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in outputs.schema if f.name != "frames")
    return outputs.mapInArrow(run, f"{types}, output_sha256 string, restored_sha256 string")


def round_trip(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256) per row of
    ``docs``: stored in the shared folder, split, and rebuilt from the outputs."""
    return digests(fill_in_middle(write_store(docs, shared_folder(spark, "frames"))))


# The same rules in DuckDB SQL.
FIM_SQL = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
         sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS x FROM documents),
h AS (
  SELECT doc_id, text, u, CAST(len(u) AS BIGINT) AS n,
         CAST('0x' || substr(x, 1, 8) AS BIGINT) % (len(u) + 1) AS k1, CAST('0x' || substr(x, 9, 8) AS BIGINT) % (len(u) + 1) AS k2,
         CAST('0x' || substr(x, 17, 8) AS BIGINT) % 100 AS r3, CAST('0x' || substr(x, 25, 8) AS BIGINT) % 100 AS r4 FROM t),
f AS (
  SELECT doc_id, text, n, coalesce(array_to_string(u[1:least(k1, k2)], ''), '') AS pre,
         coalesce(array_to_string(u[least(k1, k2) + 1:greatest(k1, k2)], ''), '') AS mid,
         coalesce(array_to_string(u[greatest(k1, k2) + 1:], ''), '') AS suf,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR r3 >= 90 THEN 'plain'
              WHEN r4 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
o AS (
  SELECT *, CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                      ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END AS output FROM f),
p AS (SELECT *, instr(output, '<P>') AS ip, instr(output, '<S>') AS i_s, instr(output, '<M>') AS im FROM o)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(pre) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(mid) AS BIGINT) END AS middle_chars, sha256(output) AS output_sha256,
       sha256(CASE form WHEN 'plain' THEN output
                        WHEN 'psm' THEN substr(output, 4, i_s - 4) || substr(output, im + 3) || substr(output, i_s + 3, im - i_s - 3)
                        ELSE substr(output, ip + 3, im - ip - 3) || substr(output, im + 3) || substr(output, 4, ip - 4) END) AS restored_sha256
FROM p
"""
