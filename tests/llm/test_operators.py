"""The other text operators against brute force, library output, round trips and held-out labels."""

import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers
from pyspark.sql import functions as F

import corpus_pipeline
from adlytics.llm import bpe, catalog, flatfile, gbt, lengths, mcd, pareto, toxicity, urls
from adlytics.llm.common import documents, labels
from adlytics.llm.stats import COUNTS, DocStats
from tests.conftest import SF_CHECK, SF_SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BYTE = public_tokenizers.path(catalog.BYTE_BPE)
WORDS = public_tokenizers.path(catalog.WORD_BPE)
DOC = "doc_id long, text string, lang string, source string, size int, row string, _q double"
ODD = [(1, None, None, None), (2, "", "en", "a"), (2, "", "en", "a"), (None, "null id  here", "en", None),
       (5, "é" * 3 + " \t\n ü" * 30, "fr", "b"), (6, "x" * 200_000, "en", "a"), (7, "tie tie tie", "en", "a"), (7, "tie tie tie", "en", "a")]


def odd_docs(spark, n=None):
    rows = [(*r, 9, "clash", 0.5) for r in ODD]
    df = spark.createDataFrame(rows, DOC)
    return df if n is None else df.limit(n)


def library():
    import tiktoken
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(BYTE), special_tokens={})


def test_bpe_matches_library_and_decodes(spark):
    enc, rng = library(), random.Random(4)
    texts = ["", "a", "aaaaaaaa" * 50, "it's we'll  \t\tfoo\n\n", "ab" * 999, "你好 \U0001f600", "x" * 5000]
    texts += ["".join(rng.choice("ab' \n\té你1!s.") for _ in range(rng.randrange(60))) for _ in range(1500)]
    odd = ["a   b", " 　 z", "a b", "\x1c\x1d x", "a\x85b"]
    b = bpe.Bpe(bpe.read_ranks(BYTE), public_tokenizers.PATTERN)
    for group in (texts, odd):
        ids, counts = b.encode(pa.array(group, pa.large_string()))
        assert counts.tolist() == b.lengths(pa.array(group, pa.large_string())).tolist()
        for t, part in zip(group, np.split(ids, np.cumsum(counts)[:-1])):
            assert part.tolist() == enc.encode_ordinary(t), t
            assert b.decode(part.tolist()) == t.encode()
    got = bpe.digests(odd_docs(spark), BYTE, public_tokenizers.PATTERN).collect()
    want = sorted((str(d), len(i := enc.encode_ordinary(t or "")), hashlib.sha256(",".join(map(str, i)).encode()).hexdigest(),
                   hashlib.sha256((t or "").encode()).hexdigest()) for d, t, *_ in ODD)
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == want
    table = bpe.decode_table(bpe.encode_table(odd_docs(spark), BYTE, public_tokenizers.PATTERN), BYTE)
    assert all(bytes(r.decoded) == (r.text or "").encode() for r in table.collect())
    assert bpe.digests(odd_docs(spark, 0), BYTE, public_tokenizers.PATTERN).count() == 0


def test_rank_bitmap_gives_the_smallest():
    q, rng, held = bpe.RankBitmap(50_000), random.Random(1), set()
    for _ in range(3000):
        x = rng.randrange(50_000)
        if rng.random() < 0.6:
            q.add(x)
            held.add(x)
        elif held:
            q.remove(y := q.first())
            held.remove(y)
        assert q.first() == (min(held) if held else -1)


def test_flat_files_round_trip(spark):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(WORDS)
    t.encode_special_tokens = True
    folder = flatfile.shared_folder(spark, "flat-test")
    index = flatfile.write_corpus(odd_docs(spark), WORDS, folder)
    rows = sorted(((d, t.encode(x or "", add_special_tokens=False).ids + [1]) for d, x, *_ in ODD),
                  key=lambda r: (r[0] is not None, r[0] or 0))
    start, want = 0, []
    for d, ids in rows:
        want.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in flatfile.read_corpus(spark, folder).collect()), key=lambda r: r[1])
    assert got == want
    every = [i for _, ids in rows for i in ids]
    assert flatfile.read_slice(folder, 3, len(every) - 5).tolist() == every[3:-2]
    assert index["parts"][-1]["base"] + index["parts"][-1]["n_ids"] == len(every)
    assert flatfile.round_trip(odd_docs(spark, 0), WORDS).count() == 0


def test_piece_tokenizer_matches_library():
    from tokenizers import Tokenizer
    t, rng = Tokenizer.from_file(WORDS), random.Random(2)
    t.encode_special_tokens = True
    texts = ["", "It's WE'LL 's 'S", "x!!y a-'s", "<|endoftext|> hi", "É é Å", "\x01 a\x01b", "İstanbul", "ΑΣ. Σ"]
    texts += ["".join(rng.choice("aBc'sS!-.«»é1 \n\t́…TtR") for _ in range(rng.randrange(40))) for _ in range(1500)]
    ids, counts = flatfile.PieceTokenizer(WORDS).encode(pa.array(texts, pa.large_string()))
    for x, part in zip(texts, np.split(ids, np.cumsum(counts)[:-1])):
        assert part.tolist() == t.encode(x, add_special_tokens=False).ids, x


def test_added_tokens_in_texts_as_by_library_defaults(spark):
    from tokenizers import Tokenizer
    t, rng = Tokenizer.from_file(WORDS), random.Random(5)
    texts = ["End of it <|endoftext|> next", "<|ENDOFTEXT|> a", "a<|endoftext|><|startoftext|>b", "<|endof", "text|> c",
             "e<|endoftext|>\u0301", " <|endoftext|> ", "", "<|<|endoftext|>|>", "<|endoftext|>"]
    parts = ["<|endoftext|>", "<|startoftext|>", "<|", "|>", "endoftext", "It's", "\x01", " ", "\n", "É", "«", "!", "<|EndOfText|>"]
    texts += ["".join(rng.choice(parts) for _ in range(rng.randrange(12))) for _ in range(1500)]
    want = [t.encode(x, add_special_tokens=False).ids for x in texts]
    assert want[0] == [806, 539, 585, 49407, 1131]
    tok = flatfile.PieceTokenizer(WORDS, added=True)
    for _ in range(2):
        ids, counts = tok.encode(pa.array(texts, pa.large_string()))
        for x, part, own in zip(texts, np.split(ids, np.cumsum(counts)[:-1]), want):
            assert part.tolist() == own, x
    got = flatfile.round_trip(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), WORDS).collect()
    assert sorted((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) \
        == [(i, len(x) + 1, zlib.crc32(np.array(x + [1], "<u4").tobytes())) for i, x in enumerate(want)]


def test_length_histogram(spark):
    enc = library()
    docs = documents(spark, SF_SMALL).unionByName(odd_docs(spark).select("doc_id", "text", "lang", "source"), allowMissingColumns=True)
    by = {}
    for r in docs.collect():
        by.setdefault(r.source, []).append(len(enc.encode_ordinary(r.text or "")))
    rows = lengths.context_limits(docs, BYTE, public_tokenizers.PATTERN).collect()
    assert len(rows) == sum(len(set(v)) for v in by.values())
    for r in rows:
        v = by[r.grp]
        assert (r.n_docs, r.docs_at_least, r.docs_total, r.tokens_total, r.tokens_truncated) == (
            v.count(r.n_tokens), sum(x >= r.n_tokens for x in v), len(v), sum(v), sum(min(x, r.n_tokens) for x in v))
        assert r.docs_share == pytest.approx(sum(x <= r.n_tokens for x in v) / len(v))
    hist = lengths.length_histogram(lengths.encoded_lengths(docs, BYTE, public_tokenizers.PATTERN))
    for r in lengths.answers(hist, [0, 100, 1000]).collect():
        v = by[r.grp]
        assert (r.docs_over, r.tokens_truncated) == (sum(x > r.limit for x in v), sum(min(x, r.limit) for x in v))


def test_statistics_match_brute_force():
    rng = random.Random(3)
    texts = ["", "\n", "\n\n a\n a\n"] + ["".join(rng.choice("ab é\n\t#|") for _ in range(rng.randrange(80))) for _ in range(1500)]
    got = DocStats()(pa.array(texts, pa.large_string()))
    assert list(got) == COUNTS
    for i, t in enumerate(texts):
        w = WORD.findall(t)
        tri = [tuple(w[k:k + 3]) for k in range(len(w) - 2)]
        repeated = {k + j for k, x in enumerate(tri) if tri.count(x) > 1 for j in range(3)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        assert (got["n_words"][i], got["word_chars"][i], got["n_symbols"][i], got["n_dup_lines"][i], got["n_repeat_words"][i]) == (
            len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(repeated)), t


def test_quality_rules(spark):
    got = mcd.judge(documents(spark, SF_CHECK)).join(labels(spark, SF_CHECK), "doc_id").toPandas()
    passed = got[~got.base_failed]
    assert passed[passed.quality == 1].kept.mean() > 0.98 and passed[passed.quality == 0].kept.mean() < 0.05
    assert not got[got.base_failed].kept.any()
    odd = mcd.judge(odd_docs(spark)).collect()
    assert len(odd) == len(ODD) and not any(r.kept and r.n_words < 50 for r in odd)
    assert mcd.judge(odd_docs(spark, 0)).count() == 0
    kept = mcd.kept_rows(odd_docs(spark))
    assert kept.columns == odd_docs(spark).columns and kept.count() == sum(r.kept for r in odd)


def test_mcd_ignores_a_minority_of_outliers():
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal([1, 2], [0.5, 1.0], (4000, 2)), rng.normal([8, 9], 0.2, (1500, 2))])
    s2 = np.einsum("ij,ik->ijk", x, x)
    mu, cov = mcd.Mcd(np.ones(len(x)), x, s2, [0.01, 0.01]).fit()
    assert np.allclose(mu, [1, 2], atol=0.1) and np.allclose(np.sqrt(np.diag(cov)), [0.5, 1.0], atol=0.12)
    assert mcd.chi2_quantile(0.95, 5) == pytest.approx(11.0705, abs=1e-3)


def test_pareto_mix_matches_sql(spark):
    rows = [(*r, 9, "clash", 0.5) for r in ODD[:5]] + [(i, "w " * (i % 40), "en", f"s{i % 7}" if i % 3 else "hot", 1, "r", 0.1) for i in range(10, 900)]
    df = spark.createDataFrame(rows, DOC)
    got = pareto.mix_documents(df).toPandas()
    con = duckdb.connect()
    con.register("docs", df.select("doc_id", "text", "source").toArrow())
    want = con.execute(pareto.MIX_SQL.format(docs="docs") + "SELECT doc_id, source, size, target, copies FROM mixed WHERE size > 0").df()
    key = ["doc_id", "source", "size"]
    a = got[got["size"] > 0].sort_values(key)[key + ["target", "copies"]].reset_index(drop=True)
    b = want.sort_values(key).reset_index(drop=True)
    assert (a["copies"] == b["copies"]).all() and np.allclose(a.target, b.target)
    assert got.copies.between(0, 2).all() and got.taken.sum() <= 1.5 * got["size"].sum() + 7 * 40
    for _, g in got.groupby("source", dropna=False):
        assert abs(g.taken.sum() - g.target.iloc[0]) <= 40
    mixed = pareto.mixed_rows(df)
    assert mixed.columns == df.columns and mixed.count() == got.copies.sum()
    assert pareto.mix_documents(df.limit(0)).count() == 0


def test_classifiers_on_held_out_labels(spark):
    docs, known = documents(spark, SF_CHECK), labels(spark, SF_CHECK)
    tox = toxicity.toxicity(docs, known).join(known, "doc_id").toPandas()
    learnt = tox[~tox.held_out]
    assert learnt[learnt.toxic == 0].predicted.mean() < 0.05 and learnt[learnt.toxic == 1].score.mean() > 0.6
    good = gbt.quality(docs, known).join(known, "doc_id").filter("held_out").toPandas()
    assert (good.predicted == good.quality).mean() > 0.9
    model = toxicity.train(docs, known)
    hit = toxicity.score(docs, model).filter("predicted = 1").join(docs, "doc_id").limit(5).collect()
    for r in hit:
        assert all(0 <= s.start < s.end <= len(r.text.encode()) and s.score >= 0.5 for s in r.offending)
    kept = toxicity.clean(odd_docs(spark), model)
    assert kept.columns == odd_docs(spark).columns and kept.count() == len(ODD)
    for d in (odd_docs(spark), odd_docs(spark, 0)):
        n = d.count()
        assert toxicity.toxicity(d, known.limit(0)).count() == n and gbt.quality(d, known.limit(0)).count() == n


def test_noisy_or_finds_the_sentence():
    texts = ["good day here. you vile thing! bye now"] * 30 + ["good day here. you nice thing! bye now"] * 30
    cut = toxicity.Sentences()
    f, s, t, a, b = cut(pa.array(texts, pa.large_string()))
    y = np.array([1] * 30 + [0] * 30)
    m = toxicity.Mil().fit(f, s, t, y, np.ones(60))
    p = 1 / (1 + np.exp(-m.logits(f, s, len(t))))
    assert p[1] > 0.5 > max(p[0], p[2]) and texts[0][a[1]:b[1]] == "you vile thing"


def test_trees_learn_and_traverse():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    t = gbt.Trees().fit(x[:2000], y[:2000], trees=40)
    assert ((t.predict(x[2000:]) > 0.5) == (y[2000:] == 1)).mean() > 0.95


def test_url_filter(spark):
    pages = [(1, "http://A.Example.NET/en/x?q=1", "<p>cheap pills spam farm</p>"), (2, "https://sub.foo.net/de/", None),
             (3, "http://example.net", "cheap cheap pills pills"), (4, None, ""), (5, "no scheme", None), (6, "ftp://m.org/fr/9#t", "free bets"),
             (7, "http://x.example.com/de/1", None), (8, "http://cheappills.org/en/2", None), (9, "http://cheappills.org/en/2", None),
             (9, "http://cheappills.org/en/2", None), (10, "http://good.org/en/1", None), (11, "http://nice.org/en/2", None)]
    df = spark.createDataFrame([(*p, "h", "v") for p in pages], "page_id long, url string, html string, host string, verdict string")
    got = {r.page_id: r for r in urls.judge(df).collect()}
    assert urls.judge(df).count() == len(pages) and urls.judge(df.limit(0)).count() == 0
    assert (got[1].host, got[1].path, got[1].rule, got[1].verdict) == ("a.example.net", "/en/x", "example.net/en/", "allow")
    assert (got[2].rule, got[2].verdict) == ("net/", "block") and got[3].rule is None and got[3].path == ""
    assert (got[4].host, got[4].path, got[5].host) == ("", "", "")
    assert got[6].rule == "org/fr/" and got[7].rule == "example.com/de/"
    assert list(got[8].words) == ["cheap", "pills"] and got[8].verdict == "block"
    assert got[10].verdict == "allow"


def test_pipeline_stages(spark):
    docs = documents(spark, SF_SMALL)
    stages = dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "quality_rules", "near_dedup", "mixing", "byte_bpe"]
    before = docs
    for name in ("toxicity", "quality_rules", "near_dedup"):
        after = stages[name](spark, before, SF_SMALL)
        assert after.columns == docs.columns
        assert after.join(before, "doc_id", "left_anti").count() == 0 and 0 < after.count() <= before.count()
        before = after
    out = corpus_pipeline.run(spark, SF_SMALL)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    text = {r.doc_id: r.text for r in docs.collect()}
    enc = library()
    for r in out.limit(20).collect():
        assert r.n_tokens == len(enc.encode_ordinary(text[r.doc_id]))
        assert r.decoded_sha256 == hashlib.sha256(text[r.doc_id].encode()).hexdigest()
    assert out.groupBy("doc_id").count().agg(F.max("count")).first()[0] <= 2
