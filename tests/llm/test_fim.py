"""Fill-in-the-middle from compressed frames against plain strings."""

import hashlib
import random
import re

import duckdb
import pytest
import zstandard

from adlytics.llm import catalog, fim
from adlytics.llm.common import shared_folder
from tests.conftest import SF_SMALL

UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]")


def expected(d, text):
    text = text or ""
    u = UNIT.findall(text)
    n = len(u)
    x = hashlib.sha256(f"1:{'' if d is None else d}".encode()).hexdigest()
    h = [int(x[8 * i:8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    pre, mid, suf = "".join(u[:a]), "".join(u[a:b]), "".join(u[b:])
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return d, n, "plain", None, None, sha(text), sha(text)
    form = "spm" if h[3] % 100 < 20 else "psm"
    out = f"<S>{suf}<P>{pre}<M>{mid}" if form == "spm" else f"<P>{pre}<S>{suf}<M>{mid}"
    return d, n, form, len(pre), len(mid), sha(out), sha(text)


def texts(rng):
    alphabet = ["a", "B", "zz", " ", "\n", "é", "你", "\U0001f600", "<", "P", ">", "<S", "M>", "1"]
    out = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(200))) for _ in range(200)]
    return out + ["", None, "<P>", "a<M>b", "<", ">", "<S", "é" * 70_000, "x" * 200_000, "y" * 70_000 + " " + "你" * 90_000,
                  " \r\n\x0b\x85\x00", "".join(rng.choice(alphabet) for _ in range(120_000))]


def test_documents(spark):
    rng = random.Random(6)
    rows = [(i, t, "form", 1, b"f") for i, t in enumerate(texts(rng))]
    rows += [(None, "no id here", "", 0, b""), (3, rows[3][1], "", 0, b""), (3, rows[3][1], "", 0, b"")]
    df = spark.createDataFrame(rows, "doc_id long, text string, form string, n int, frames binary").repartition(3)
    got = fim.round_trip(spark, df).collect()
    assert sorted(map(tuple, got), key=str) == sorted((expected(d, t) for d, t, *_ in rows), key=str)
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    assert fim.round_trip(spark, df.limit(0)).collect() == []


@pytest.mark.parametrize("size", [4, 7, 64])
def test_frames_of_any_size(size):
    """Frames end between code points, counts are cumulative, and any range can be read."""
    rng = random.Random(size)
    letters, pack, unpack = fim.letter_table(), zstandard.ZstdCompressor(), zstandard.ZstdDecompressor()
    for text in texts(rng)[:120] + ["q" * 50 + "é" * 9]:
        w = fim.FrameWriter(pack, letters, size)
        raw = (text or "").encode()
        for i in range(0, len(raw), 5):
            w.write(raw[i:i + 5])
        frames, n, chars = w.finish()
        units = UNIT.findall(text or "")
        assert (n, chars) == (len(units), len(text or ""))
        r = fim.FrameReader([dict(zip(("data", "units", "chars", "joined"), f)) for f in frames], unpack, letters)
        parts = [r.frame(i).decode() for i in range(len(frames))]
        assert "".join(parts) == (text or "") and all(len(p.encode()) <= size for p in parts)
        for k in {0, n, n // 2, rng.randrange(n + 1)}:
            before = "".join(units[:k])
            assert r.place(k, n, chars) == (len(before.encode()), len(before))
        a, b = sorted(rng.randrange(len(raw) + 1) for _ in range(2))
        assert b"".join(r.stream(a, b)) == raw[a:b]


def test_outputs_are_texts(spark):
    """The stored frames hold the output itself, and cuts read one frame."""
    folder = shared_folder(spark, "frames-test")
    df = spark.createDataFrame([(11, "alpha beta " * 20_000), (12, "short one")], "doc_id long, text string")
    out = {r.doc_id: r for r in fim.fill_in_middle(fim.write_store(df, folder)).collect()}
    codec = zstandard.ZstdDecompressor()
    for d, text in ((11, "alpha beta " * 20_000), (12, "short one")):
        body = b"".join(codec.decompress(f["data"]) for f in out[d].frames).decode()
        assert hashlib.sha256(body.encode()).hexdigest() == expected(d, text)[5]
    reader = fim.FrameReader([f.asDict() for f in spark.read.parquet(folder).filter("doc_id = 11").first().frames], codec, fim.letter_table())
    seen = []
    reader.frame = lambda i, of=reader.frame: seen.append(i) or of(i)
    reader.place(30_000, 80_000, 220_000)
    assert len(set(seen)) == 1 and len(reader.data) > 3


def test_sql_twin(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF_SMALL}/documents.parquet')")
    res = con.execute(fim.FIM_SQL)
    cols = [d[0] for d in res.description]
    got = catalog.op13_fim_frames(spark, SF_SMALL)
    assert got.columns == cols
    assert sorted(map(tuple, got.collect())) == sorted(res.fetchall())
