"""URL filters (operator 8): host and path rules, and naive Bayes over segmented host names.

Rules (host/path) fit a host and its subdomains if the path starts with the rule's; the longest
wins. Other URLs are judged by a multinomial naive Bayes over their words: host names are cut at
dots, hyphens and digits and then split into words by a unigram Viterbi search (``cheappills`` ->
``cheap pills``), paths at everything but letters, numbers becoming ``#``. The last host label is
left out, as the rules speak of it.

Unigrams are counted over the visible text and URLs' paths of all pages. Words of a name are looked up by
a join of the substrings of distinct names with the unigram table, so no task holds the
vocabulary. The classifier learns from all pages: the ones with a word of the seed list are
examples to block, the others to allow; words that keep company with seeds take on weight.
"""

from __future__ import annotations

import math
import string

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlytics.llm.bpe import distinct_pieces
from adlytics.llm.common import saved
from adlytics.llm.textvec import blocks, buffers, plain_strings, word_spans

# The rules of the task.
RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]
# Words that mark a URL as an example to block.
SEEDS = ["ads", "adult", "bet", "bets", "casino", "lottery", "pills", "poker", "porn", "spam", "track", "viagra", "xxx"]
LONGEST = 24             # code points of the longest word that is looked up


def parts(url: str = "url") -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    at = F.instr(F.col(url), "://")
    rest = F.expr(f"substring({url}, instr({url}, '://') + 3)")
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    none = F.col(url).isNull() | (at == 0)
    return (F.when(none, "").otherwise(F.translate(host, string.ascii_uppercase, string.ascii_lowercase)),
            F.when(none, "").otherwise(path))


def rule_of(rules=RULES) -> Column:
    """Struct (rule, verdict) of the longest rule that fits columns host and path, or null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        host, slash, path = rule.partition("/")
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(slash + path)
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def page_unigrams(pages: DataFrame) -> DataFrame:
    """(word, n): lower-cased letter runs of the pages' visible text, counted in tasks first."""
    def run(batches):
        gaps = np.zeros(256, bool)
        for i in range(128):
            gaps[i] = not chr(i).isalpha()
        for batch in batches:
            html = plain_strings(batch.column("html"))
            for i, j in blocks(html, 8 << 20):
                text = pc.replace_substring_regex(html[i:j], r"(?s)<script.*?</script>|<style.*?</style>|<[^>]*>|&[a-z]+;", " ")
                d, off = buffers(pc.utf8_lower(text))
                s, e, _ = word_spans(d, off, gaps)
                if not len(s):
                    continue
                length = e - s
                at = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length) + np.repeat(s, length)
                words, number, _ = distinct_pieces(d[at], np.array([0, len(at)]), np.cumsum(length) - length)
                yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(np.bincount(number))], names=["word", "n"])
    return pages.select("html").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def name_parts(host: Column) -> Column:
    """Host labels but the last, cut at hyphens, digits and other non-letters."""
    labels = F.split(host, r"\.")
    inner = F.concat_ws("-", F.when(F.size(labels) > 1, F.slice(labels, 1, F.greatest(F.size(labels) - 1, F.lit(1)))).otherwise(labels))
    return F.filter(F.split(inner, r"[^\p{L}]+"), lambda x: x != "")


def segment(names: DataFrame, unigrams: DataFrame) -> DataFrame:
    """(name, words): the most probable split of each distinct name (``name``).

    Known words have the log of their share; an unknown stretch of k letters the log of
    10 / (N * 10^k), so known words win where they fit.
    """
    total = float(unigrams.agg(F.sum("n")).first()[0] or 1)
    starts = names.select("name", F.explode(F.sequence(F.lit(1), F.length("name"))).alias("at"))
    spans = starts.select("name", "at", F.explode(F.sequence(
        F.lit(1), F.least(F.lit(LONGEST), F.length("name") - F.col("at") + 1))).alias("size")) \
        .withColumn("word", F.expr("substring(name, at, size)"))
    known = spans.join(unigrams, "word").groupBy("name").agg(
        F.collect_list(F.struct("at", "size", F.log(F.col("n") / total).alias("p"))).alias("known"))
    rows = names.join(known, "name", "left").select("name", "known")

    def viterbi(batches):
        for batch in batches:
            out = []
            for name, spans in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ends: dict[int, list] = {}
                for w in spans or []:
                    ends.setdefault(w["at"] - 1 + w["size"], []).append((w["at"] - 1, w["p"]))
                best, cut = [0.0] + [-math.inf] * len(name), [0] * (len(name) + 1)
                for end in range(1, len(name) + 1):
                    unknown = [(a, math.log(10 / total) - (end - a) * math.log(10)) for a in range(max(0, end - LONGEST), end)]
                    for a, p in unknown + ends.get(end, []):
                        if best[a] + p > best[end]:
                            best[end], cut[end] = best[a] + p, a
                words, end = [], len(name)
                while end:
                    words.append(name[cut[end]:end])
                    end = cut[end]
                out.append(words[::-1])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(pa.string()))], names=["name", "words"])

    return rows.mapInArrow(viterbi, "name string, words array<string>")


def word_scores(table: DataFrame, key: str, weights: DataFrame, alias: str) -> DataFrame:
    """(key, alias): sum of the weights of each row's words."""
    return table.select(key, F.explode("words").alias("word")).join(weights, "word") \
        .groupBy(key).agg(F.sum("weight").alias(alias))


def judge(pages: DataFrame, rules=RULES, seeds=SEEDS) -> DataFrame:
    """(page_id, host, path, rule, verdict, score, words), one row per row of ``pages`` (page_id,
    url, html). ``score`` is the log odds of block of the classifier, also where a rule decides;
    ``words`` are the host's. Null urls, or without ``://``, have empty parts, no words and the
    prior as their score; an empty table gives no rows."""
    host, path = parts()
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    tokens = F.filter(F.split(F.lower(F.col("path")), r"[^\p{L}\p{N}]+"), lambda x: x != "")
    tokens = F.transform(tokens, lambda x: F.when(x.rlike(r"^\p{N}+$"), "#").otherwise(x))
    rows = saved(rows.withColumn("r", rule_of(rules)).withColumn("pattern", F.array_join(tokens, " "))
                 .select("page_id", "host", "path", "r.rule", F.col("r.verdict").alias("by_rule"), "pattern"))
    pairs = saved(rows.groupBy("host", "pattern").agg(F.count(F.lit(1)).alias("n")))
    patterns = pairs.select("pattern").distinct() \
        .withColumn("words", F.filter(F.split("pattern", " "), lambda x: x != ""))
    path_words = pairs.select(F.explode(F.split("pattern", " ")).alias("word"), "n").filter("word <> '' AND word <> '#'")
    unigrams = saved(page_unigrams(pages).union(path_words).groupBy("word").agg(F.sum("n").alias("n")))
    hosts = pairs.select("host").distinct().withColumn("parts", name_parts(F.col("host")))
    names = hosts.select(F.explode("parts").alias("name")).distinct()
    split = segment(names, unigrams)
    host_words = saved(hosts.select("host", F.posexplode("parts").alias("pos", "name")).join(split, "name")
                       .groupBy("host").agg(F.sort_array(F.collect_list(F.struct("pos", "words"))).alias("w"))
                       .select("host", F.flatten("w.words").alias("words")))

    both = pairs.join(host_words, "host", "left") \
        .withColumn("words", F.concat(F.coalesce("words", F.array().cast("array<string>")),
                                      F.filter(F.split("pattern", " "), lambda x: x != "")))
    both = both.withColumn("bad", F.arrays_overlap("words", F.array(*map(F.lit, seeds))))
    docs = both.agg(F.sum(F.when(F.col("bad"), F.col("n"))).alias("b"), F.sum(F.when(~F.col("bad"), F.col("n"))).alias("a")).first()
    counts = saved(both.select(F.explode("words").alias("word"), "bad", "n").groupBy("word").agg(
        F.sum(F.when(F.col("bad"), F.col("n")).otherwise(0)).alias("b"),
        F.sum(F.when(F.col("bad"), 0).otherwise(F.col("n"))).alias("a")))
    t = counts.agg(F.count(F.lit(1)).alias("v"), F.sum("b").alias("b"), F.sum("a").alias("a")).first()
    prior = math.log(((docs.b or 0) + 1) / ((docs.a or 0) + 1))
    shift = math.log(((t.a or 0) + t.v + 1) / ((t.b or 0) + t.v + 1))
    weights = counts.select("word", (F.log((F.col("b") + 1) / (F.col("a") + 1)) + F.lit(shift)).alias("weight"))
    host_scores = host_words.join(word_scores(host_words, "host", weights, "hs"), "host", "left").select("host", "words", "hs")
    path_scores = word_scores(patterns, "pattern", weights, "ps")
    out = rows.join(host_scores, "host", "left").join(path_scores, "pattern", "left") \
        .withColumn("score", F.lit(prior) + F.coalesce("hs", F.lit(0.0)) + F.coalesce("ps", F.lit(0.0)))
    return out.select("page_id", "host", "path", "rule",
                      F.coalesce("by_rule", F.when(F.col("score") > 0, "block").otherwise("allow")).alias("verdict"),
                      "score", F.coalesce("words", F.array().cast("array<string>")).alias("words"))
