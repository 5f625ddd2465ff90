"""URL filter: rules first, then naive Bayes over words that a unigram model finds in concatenated names.

1. The longest rule that fits a url decides it.
2. Runs of letters in hosts and paths are tokens. Each distinct token is split once: its substrings of the lengths that
   words have are joined with the word counts of all pages, and the most probable split is found from left to right
   (Viterbi). Words may have any length, and so may runs that are no words.
3. Urls that a rule decided teach a multinomial naive Bayes model. Tokens are counted by class before they meet
   their words, so that a token in every url is one row.
4. Urls without a rule, each distinct one once, get the sum of the weights of their words.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillvec.llm.tables import Scratch

#: (host, start of the path, verdict)
RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block"))
#: Stands for any run of digits.
NUMBER = "0"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """From the first ``://`` to the next ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, as ``host`` and ``path`` in one, and its verdict; NULL if none does.

    A rule fits its host and all subdomains, if the path starts with that of the rule. Of equally long rules the one
    with the longer host wins.
    """
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule_host, start, decision in sorted(rules, key=lambda r: (len(r[0] + r[1]), len(r[0]))):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(start)
        name = F.when(fits, F.lit(rule_host + start)).otherwise(name)
        verdict = F.when(fits, F.lit(decision)).otherwise(verdict)
    return name, verdict


def tokens_of(host: Column, path: Column) -> Column:
    """Runs of the letters a-z, and ``NUMBER`` for each run of digits."""
    text = F.regexp_replace(F.translate(F.concat(host, F.lit("/"), path), UPPER, LOWER), "[0-9]+", f" {NUMBER} ")
    return F.filter(F.split(text, f"[^a-z{NUMBER}]+"), lambda t: t != "")


def word_counts(html: DataFrame) -> DataFrame:
    """``word, n``: runs of letters outside the tags of all pages.

    What lies between two words may be long: repeated by ``++`` it takes a loop, by ``+`` a deeper stack for each tag
    or character.
    """
    words = html.select(F.explode(F.split(F.lower("html"), "(?:<[^>]*>|[^a-z])++")).alias("word"))
    return words.filter("word != ''").groupBy("word").agg(F.count("*").alias("n"))


def segmented(tokens: DataFrame, counts: DataFrame) -> DataFrame:
    """``token, words`` for each row of ``tokens``: the split with the highest product of word probabilities.

    A piece of ``k`` letters that is no word has the probability of ten words that are seen once, divided by ten for
    each letter. Of equally good splits the one with the longer last word wins, from the right.
    """
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"))
    # Words of n different lengths have n * n / 2 letters at least, so the lengths of all words are a short list.
    lengths = counts.agg(F.collect_set(F.length("word")).alias("lengths"))
    # Pieces carry a digest in place of a long token, so a very long one isn't copied for each of them.
    named = tokens.withColumn("name", F.expr("if(length(token) <= 64, token, sha2(token, 256))"))
    pieces = named.join(F.broadcast(lengths)).selectExpr(  # one row
        "name", "token", "explode(filter(lengths, n -> n <= length(token))) AS size").selectExpr("name", "size", """
            explode(transform(sequence(1, length(token) - size + 1),
                              i -> struct(i AS start, substring(token, i, size) AS word))) AS piece""") \
        .selectExpr("name", "piece.start", "piece.start + size - 1 AS last", "piece.word")
    known = pieces.join(counts, "word").groupBy("name").agg(
        F.collect_list(F.struct("start", "last", "n")).alias("known"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, knowns, totals = (batch.column(batch.schema.get_field_index(c)).to_pylist()
                                     for c in ("token", "known", "total"))
            words = [best_split(t, {(k["start"] - 1, k["last"]): k["n"] for k in known or ()}, total)
                     for t, known, total in zip(names, knowns, totals, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(words, pa.list_(pa.string()))],
                                             ["token", "words"])

    return named.join(known, "name", "left").join(F.broadcast(total)).mapInArrow(  # one row
        run, "token string, words array<string>")


def best_split(token: str, counts: dict[tuple[int, int], int], total: int) -> list[str]:
    """``counts`` has how often the piece of ``token`` between two places occurs as a word."""
    size, ten = math.log(max(total, 1)), math.log(10)
    ending: dict[int, list[tuple[int, int]]] = {}
    for (start, end), n in counts.items():
        ending.setdefault(end, []).append((start, n))
    best, cut = [0.0], [0]
    # A piece that is no word costs the same for each letter, so the best place for it to start is known from before.
    unknown, lead = 0, 0.0
    for end in range(1, len(token) + 1):
        score, start = max([(best[unknown] + ten * (1 - (end - unknown)) - size, -unknown),
                            *((best[s] + math.log(n) - size, -s) for s, n in ending.get(end, ()))])
        best.append(score)
        cut.append(-start)
        if score + end * ten > lead:
            unknown, lead = end, score + end * ten
    out, end = [], len(token)
    while end:
        out.append(token[cut[end]:end])
        end = cut[end]
    return out[::-1]


def judged_urls(pages: DataFrame, rules=RULES) -> DataFrame:
    """``page_id, host, path, rule, verdict, score`` of each row of ``pages``.

    ``score`` is the logarithm of the odds for ``block``, NULL where a rule decides; above zero the verdict is
    ``block``, else ``allow``. Where one class has no examples, both count as equally likely at the start.

    A NULL url, or one without ``://``, has an empty host and path and no words. A NULL ``html`` has no words. Rows are
    judged one by one, repeated ones too; a NULL ``page_id`` comes back as NULL. Other columns are left out.
    """
    scratch = Scratch(pages.sparkSession, "urls")
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    urls = pages.select("page_id", host.alias("host"), path.alias("path")) \
        .withColumns({"rule": rule, "decided": verdict})
    counts = scratch.keep(word_counts(pages), "counts")
    distinct = urls.groupBy("host", "path", "decided").agg(F.count("*").alias("n"))
    tokens = scratch.keep(distinct.select("host", "path", "decided", "n", F.explode(
        tokens_of(F.col("host"), F.col("path"))).alias("token")), "tokens")
    words = scratch.keep(segmented(tokens.select("token").distinct(), counts), "words")
    weights = scratch.keep(_token_weights(tokens, words), "weights")
    classes = urls.agg(F.count_if(F.col("decided") == "block").alias("b"), F.count_if(F.col("decided") == "allow").alias("a"))
    prior = classes.select(F.when((F.col("a") > 0) & (F.col("b") > 0), F.log(F.col("b") / F.col("a")))
                           .otherwise(0.0).alias("prior"))
    open_urls = distinct.filter("decided IS NULL").select("host", "path")
    sums = tokens.filter("decided IS NULL").join(weights, "token").groupBy("host", "path") \
        .agg(F.sum("weight").alias("weight"))
    scores = scratch.keep(open_urls.join(sums, ["host", "path"], "left").join(F.broadcast(prior))  # one row
                          .select("host", "path", (F.col("prior") + F.coalesce("weight", F.lit(0.0))).alias("score")),
                          "scores")
    scored = urls.filter("decided IS NULL").join(scores, ["host", "path"], "left")
    by_words = F.when(F.col("score") > 0, "block").otherwise("allow")
    return urls.filter("decided IS NOT NULL").select("page_id", "host", "path", "rule", F.col("decided").alias("verdict"),
                                                     F.lit(None).cast("double").alias("score")) \
        .unionByName(scored.select("page_id", "host", "path", "rule", by_words.alias("verdict"),
                                   F.round("score", 6).alias("score")))


def _token_weights(tokens: DataFrame, words: DataFrame) -> DataFrame:
    """``token, weight``: sum over its words of the logarithm of how much likelier each is in blocked urls, with one
    more of each word in either class."""
    seen = tokens.filter("decided IS NOT NULL").groupBy("token").agg(
        F.sum(F.when(F.col("decided") == "block", F.col("n")).otherwise(0)).alias("b"),
        F.sum(F.when(F.col("decided") == "allow", F.col("n")).otherwise(0)).alias("a"))
    by_word = words.join(seen, "token", "left").select(F.explode("words").alias("word"), "b", "a").groupBy("word").agg(
        F.coalesce(F.sum("b"), F.lit(0)).alias("b"), F.coalesce(F.sum("a"), F.lit(0)).alias("a"))
    total = by_word.agg(F.sum("b").alias("all_b"), F.sum("a").alias("all_a"), F.count("*").alias("size"))
    odds = by_word.join(F.broadcast(total)).select("word", (  # one row
        F.log((F.col("b") + 1) / (F.col("all_b") + F.col("size")))
        - F.log((F.col("a") + 1) / (F.col("all_a") + F.col("size")))).alias("odds"))
    return words.select("token", F.explode("words").alias("word")).join(odds, "word").groupBy("token") \
        .agg(F.sum("odds").alias("weight"))
