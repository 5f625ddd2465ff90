"""Benchmark decontamination by templates, in DataFrame operations only.

1. A text is cut into runs of letters and digits. Numbers, names (words with a capital first letter) and units become
   typed placeholders, the rest is in lower case; so a question has one template whatever its figures.
2. Windows of five template words are hashed and joined with those of the benchmark. Windows with fewer than three
   plain words say too little and don't count.
3. Matches of one document and one item with the same distance between their places lie on one alignment. An alignment
   that holds 80 percent of the item's windows is a candidate.
4. Slots decide: a value of the item must stand for one value in the document everywhere. If none differ the
   passage is a copy, else the question has been given other parameters. Inconsistent ones are no leaks.
5. What has no such alignment is read again with a whole number (4.5, 1,200) and a run of names (Mary Ann) as one
   placeholder, and the windows of an item add up over distances a few words apart. A window of the item that spans
   the place of an inserted or dropped word can't match; it counts if windows on both sides do.
6. Copies need no plain words: windows of the words as they are, in lower case, are joined too, so that short items,
   items full of numbers or names, and copies in another case are found. An item of fewer than five words is one
   window. In scripts without spaces each character is a word (in 5 and 6).

One scan makes the windows of all three readings, and one join with those of the benchmark lets go of all documents
without a match. Only texts of candidates are read again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillvec.llm.tables import LAST, Scratch
from quillvec.storage import sized

WINDOW = 5
PLAIN_WORDS = 3
PERCENT = 80
#: Words that may come in or drop out within a passage.
SLACK = 4
#: Characters of scripts without spaces, and others of words.
SINGLE = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}"
OTHER = rf"[\p{{L}}\p{{N}}&&[^{SINGLE}]]"
#: A whole number, a run of names, or a word. Possessive, since Java's other loops over groups go as deep as they are long.
MERGED = (rf"(?<![\p{{L}}\p{{N}}&&[^{SINGLE}]])[-+]?[0-9]{OTHER}*+(?:[.,][0-9]++)*+"
          rf"|\p{{Lu}}{OTHER}*+(?:[\s'’-]\p{{Lu}}{OTHER}*+)*+|{OTHER}++|[\p{{L}}\p{{N}}&&[{SINGLE}]]")
#: What lies between words if each character of a script without spaces is one.
BETWEEN = rf"[^\p{{L}}\p{{N}}]+|(?<=[{SINGLE}])(?=[\p{{L}}\p{{N}}])|(?<=[\p{{L}}\p{{N}}])(?=[{SINGLE}])"
#: Texts with a character beyond the scripts that need spaces; they are cut by the patterns above, others faster.
WIDE = r"[\x{0E00}-\x{1FFF}\x{2E80}-\x{10FFFF}]"
#: A whole number, and a run of names, as in MERGED.
NUMBER = r"(?<![\p{L}\p{N}])[-+]?[0-9][\p{L}\p{N}]*+(?:[.,][0-9]++)*+"
NAMES = r"(?<![\p{L}\p{N}])\p{Lu}[\p{L}\p{N}]*+(?:[\s'’-]\p{Lu}[\p{L}\p{N}]*+)*+"
#: Readings: templates word by word, templates of merged words, words as they are.
STRICT, LOOSE, LITERAL = 1, 2, 3
#: Units that a question may exchange.
UNITS = ("mm", "cm", "m", "km", "inch", "inches", "foot", "feet", "mile", "miles", "mg", "g", "kg", "gram", "grams",
         "pound", "pounds", "ml", "l", "liter", "liters", "second", "seconds", "minute", "minutes", "hour", "hours",
         "day", "days", "week", "weeks", "year", "years", "dollar", "dollars", "euro", "euros", "cent", "cents",
         "percent", "mph", "kmh")


def words_of(text: Column) -> Column:
    """Runs of letters and digits, as an array. The first or last is empty if something else begins or ends the text."""
    return F.split(F.coalesce(text, F.lit("")), r"[^\p{L}\p{N}]+")


def merged_words(text: Column) -> Column:
    """As ``words_of``, without empty ones, but a number with its sign and points is one, and so is a run of names."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(MERGED), F.lit(0))


def literal_words(text: Column) -> Column:
    """As ``words_of``, but each character of a script without spaces is a word."""
    whole = F.coalesce(text, F.lit(""))
    return F.when(whole.rlike(WIDE), F.split(whole, BETWEEN)).otherwise(words_of(text))


def _is_number(first: Column) -> Column:
    return first.between("0", "9") | first.isin("-", "+")


def template_word(word: Column) -> Column:
    first = F.substring(word, 1, 1)
    return F.when(_is_number(first), F.lit("<num>")).when(first != F.lower(first), F.lit("<name>")) \
        .when(F.lower(word).isin(*UNITS), F.lit("<unit>")).otherwise(F.lower(word))


def _is_slot(template: Column) -> Column:
    return template.startswith("<")


def leaked_items(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, percent: int = PERCENT) -> DataFrame:
    """One row for each document and item of ``benchmark`` (``item_id, text``) it holds.

    Returns ``doc_id, item_id, start`` (the word of the document where the item would begin; it is negative
    if the item's beginning is missing), ``n_windows`` of the item, ``n_matched``, ``n_slots``, ``n_changed`` and
    ``kind``: ``copy`` or ``reparameterised``. Of several places of one item the one with most windows counts, and of
    equal ones the first.

    What only step 5 or 6 finds comes with the windows and slots of that reading. Items of fewer than five words, or
    without a countable window, are found as copies only.

    Documents or items with NULL or empty texts match nothing; nor do items without a letter or digit. A NULL
    ``doc_id`` or ``item_id`` comes back as NULL. Equal rows give one row. Other columns are left out, and empty
    tables give no rows.
    """
    strict, loose, copies = _judged(docs, benchmark, window, percent)
    best = _best(strict)
    for more in (_best(loose), _best(copies)):
        best = best.unionByName(more.join(best, ["id", "item"], "left_anti"))
    nullable = [F.when(F.col(c) != LAST, F.col(c)).alias(n) for c, n in (("id", "doc_id"), ("item", "item_id"))]
    return best.select(*nullable, F.col("b.start").cast("long").alias("start"), F.col("b.n_windows").alias("n_windows"),
                       (-F.col("b.m")).alias("n_matched"), F.col("b.n_slots").cast("long").alias("n_slots"),
                       F.col("b.n_changed").cast("long").alias("n_changed"),
                       F.when(F.col("b.n_changed") == 0, "copy").otherwise("reparameterised").alias("kind"))


def _key() -> list[Column]:
    """The id of a document, or the largest number for NULL, and a hash of its text."""
    return [F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("id"),
            F.xxhash64(F.coalesce("text", F.lit(""))).alias("sub")]


def _judged(docs: DataFrame, benchmark: DataFrame, window: int, percent: int) -> list[DataFrame]:
    """Places of items in texts, with slots that are consistent: those of each reading, as written tables."""
    scratch = Scratch(docs.sparkSession, "templates")
    source = docs.select(*_key(), "text")
    items = scratch.keep(benchmark.select(
        F.coalesce(F.col("item_id").cast("long"), F.lit(LAST)).alias("item"), "text",
        F.array_remove(words_of(F.col("text")), "").alias("words"), merged_words(F.col("text")).alias("merged"),
        F.array_remove(literal_words(F.col("text")), "").alias("literal")).distinct(), "items")
    short = sorted(r.n for r in items.select(F.size("literal").alias("n")).filter(f"n BETWEEN 1 AND {window - 1}")
                   .distinct().collect())  # at most window - 1 numbers
    wanted = scratch.keep(_windows(items, ["item"], F.col("words"), F.col("literal"), window, short, whole=True)
                          .withColumnRenamed("place", "at"), "wanted")
    hits = scratch.keep(_windows(source, ["id", "sub"], words_of(F.col("text")), literal_words(F.col("text")), window,
                                 short).drop("reading").join(sized(wanted), "window").drop("window"), "hits")
    places = scratch.keep(wanted.groupBy("reading", "item").agg(F.collect_set("at").alias("all_at"))
                          .withColumn("n_windows", F.size("all_at").cast("long")), "places")
    # Equal rows of one document share a key, so places are taken once.
    aligned = hits.groupBy("reading", "id", "sub", "item", (F.col("place") - F.col("at")).alias("start")) \
        .agg(F.collect_set("at").alias("ats")).withColumn("n_matched", F.size("ats").cast("long"))
    aligned = scratch.keep(aligned.join(sized(places), ["reading", "item"]), "aligned")
    straight = scratch.keep(aligned.filter(f"reading <> {LOOSE} AND 100 * n_matched >= {percent} * n_windows")
                            .drop("ats", "all_at"), "straight")
    bent = scratch.keep(_over_joints(aligned.filter(f"reading = {LOOSE}"), scratch, window, percent), "bent")
    ids = scratch.keep(straight.select("id", "sub").union(bent.select("id", "sub")).distinct(), "ids")
    texts = scratch.keep(source.join(sized(ids), ["id", "sub"], "left_semi").dropDuplicates(["id", "sub"]), "texts")
    judged = [_strict(straight.filter(f"reading = {STRICT}"), texts, items), _loose(bent, texts, items, scratch, window),
              _copies(straight.filter(f"reading = {LITERAL}"), texts, items, scratch)]
    return [scratch.keep(df.filter("consistent"), f"judged-{n}") for n, df in enumerate(judged)]


def _best(judged: DataFrame) -> DataFrame:
    return judged.groupBy("id", "item").agg(F.min(F.struct(
        (-F.col("n_matched")).alias("m"), "start", "n_changed", "n_slots", "n_windows")).alias("b"))


def _once(value: str, use: str) -> Column:
    """``use``, in which ``x`` is ``value``: worked out once, and not in each step of a lambda function."""
    return F.expr(f"transform(array({value}), x -> {use})[0]")


def _windows(df: DataFrame, keys: list[str], words: Column, literal: Column, window: int, short: list[int],
             whole: bool = False) -> DataFrame:
    """``keys, reading, place, window``: windows of all readings of ``text``, and where they start.

    ``words`` and ``literal`` are its words for the first and the last reading. Windows shorter than ``window``, as many
    words as are listed in ``short``, are made for the last reading; with ``whole`` only where they are the whole text.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    # Digits don't begin any other word, so they can stand for what has been replaced.
    replaced = F.regexp_replace(F.regexp_replace(text, NUMBER, " 0 "), NAMES, " 1 ")
    merged = F.transform(F.split(replaced, r"[^\p{L}\p{N}]+"), lambda w: F.when(w != "", _code(w, "1")))
    merged = F.when(text.rlike(WIDE), F.transform(merged_words(text), lambda w: _code(w))).otherwise(F.array_compact(merged))
    codes = df.select(*keys, F.size(literal).alias("size"), F.transform(words, lambda w: _code(w)).alias("t"),
                      merged.alias("m"), F.transform(literal, lambda w: F.when(w != "", F.xxhash64(F.lower(w)))).alias("l"))
    # Each array side by side with itself from the next words on: a row for each place, and compiled code from there.
    parts = [c if j == 0 else f"slice({c}, {j + 1}, greatest(0, size({c}) - {j}))" for c in "tml" for j in range(window)]
    names = [c if j == 0 else str(i) for i, (c, j) in enumerate((c, j) for c in "tml" for j in range(window))]
    units = ", ".join(f"xxhash64('{u}')" for u in UNITS)
    fields = [f"w.`{n}`" for n in names]
    fields = [f"IF({f} IN ({units}), 3L, {f})" if i < 2 * window else f for i, f in enumerate(fields)]
    rows = codes.selectExpr(*keys, "size", f"posexplode(arrays_zip({', '.join(parts)})) AS (place, w)").selectExpr(
        *keys, "size", "place", *[f"{f} AS {'tml'[i // window]}{i % window}" for i, f in enumerate(fields)])
    hashed = []
    for reading, c in ((STRICT, "t"), (LOOSE, "m")):
        plain = " + ".join(f"IF({c}{j} BETWEEN 0 AND 9, 0, 1)" for j in range(window))
        hashed.append((reading, f"{c}{window - 1} IS NOT NULL AND {plain} >= {PLAIN_WORDS}",
                       ", ".join(f"{c}{j}" for j in range(window))))
    for n in (*short, window):
        there = " AND ".join(f"l{j} IS NOT NULL" for j in range(n))
        hashed.append((LITERAL, there + (f" AND size = {n}" if whole and n < window else ""),
                       ", ".join(f"l{j}" for j in range(n))))
    each = ", ".join(f"{reading}, IF({there}, xxhash64({reading}, {words}), NULL)" for reading, there, words in hashed)
    return rows.selectExpr(*keys, "place", f"stack({len(hashed)}, {each}) AS (reading, window)").filter("window IS NOT NULL")


def _code(word: Column, name: str | None = None) -> Column:
    """A small number for a number or a name, a hash for a plain word. With ``name``, that word stands for names, and
    0 for numbers."""
    if name:
        return F.when(word == "0", F.lit(1).cast("long")).when(word == name, F.lit(2).cast("long")) \
            .otherwise(F.xxhash64(F.lower(word)))
    # Signs and digits come before all letters.
    first = F.substring(word, 1, 1)
    return F.when((word < ":") & (word != ""), F.lit(1).cast("long")).when(word == F.lower(word), F.xxhash64(word)) \
        .when(first != F.lower(first), F.lit(2).cast("long")).otherwise(F.xxhash64(F.lower(word)))


def _strict(candidates: DataFrame, texts: DataFrame, items: DataFrame) -> DataFrame:
    """Judged alignments of words: both sides of the slots, at each word of the item."""
    pairs = candidates.join(texts, ["id", "sub"]).select("*", words_of(F.col("text")).alias("there")).drop("text") \
        .join(items.select("item", "words"), "item").withColumn("slots", F.expr(
            "filter(transform(words, (w, i) -> struct(w AS item, IF(start + i >= 0, get(there, int(start + i)), NULL) AS doc)), "
            "p -> p.doc IS NOT NULL)")).withColumn("slots", F.filter("slots", lambda p: _is_slot(
                template_word(p["item"])) & (template_word(p["item"]) == template_word(p["doc"]))))
    return pairs.select(
        "id", "sub", "item", "start", "n_matched", "n_windows", F.size("slots").alias("n_slots"),
        F.size(F.filter("slots", lambda p: p["item"] != p["doc"])).alias("n_changed"),
        (F.size(F.array_distinct("slots")) == F.size(F.array_distinct("slots.item"))).alias("consistent"))


def _over_joints(runs: DataFrame, scratch: Scratch, window: int, percent: int) -> DataFrame:
    """Candidates over merged words, their windows added up over distances at most ``SLACK`` words apart."""
    # Bands of distances, and others half a band on: distances that differ by SLACK at most share a band of either kind.
    banded = runs.select("*", F.expr(
        f"explode(array(floor(start / {2 * SLACK}) * 2, floor((start + {SLACK}) / {2 * SLACK}) * 2 + 1))").alias("band"))
    near = banded.groupBy("id", "sub", "item", "band").agg(
        F.sum("n_matched").alias("n"), F.first("all_at").alias("all_at"), F.first("n_windows").alias("n_windows"),
        F.collect_list(F.struct((-F.size("ats")).alias("m"), "start", "ats")).alias("runs"))
    # A window of the item counts once, at the distance that holds most; windows at a joint must be fewer than the others.
    several = near.filter("2 * n > n_windows").select("id", "sub", "item", "band", "n_windows", "all_at", _once(
        "array_sort(flatten(transform(runs, r -> transform(r.ats, a -> struct(a AS at, r.m AS m, r.start AS start)))))",
        "filter(x, (p, i) -> i = 0 OR p.at <> x[i - 1].at)").alias("every"))
    chosen = scratch.keep(several, "several").withColumn("n_joint", F.expr(
        "aggregate(filter(transform(every, (p, i) -> struct(every[greatest(0, i - 1)] AS a, p AS b)), "
        f"g -> g.a.start <> g.b.start AND g.b.at - g.a.at <= {window + SLACK}), 0, "
        "(s, g) -> s + size(filter(all_at, y -> y > g.a.at AND y < g.b.at)))")) \
        .withColumn("n_matched", F.expr("CAST(size(every) + n_joint AS BIGINT)")) \
        .filter(f"100 * n_matched >= {percent} * n_windows AND 2 * size(every) > n_windows")
    return chosen.select("id", "sub", "item", "band", "every", "n_matched", "n_windows")


def _loose(candidates: DataFrame, texts: DataFrame, items: DataFrame, scratch: Scratch, window: int) -> DataFrame:
    """Judged candidates over merged words."""
    both = candidates.join(texts, ["id", "sub"]) \
        .select("*", merged_words(F.col("text")).alias("there"),
                (F.element_at(words_of(F.col("text")), 1) == "").cast("int").alias("lead")).drop("text") \
        .join(items.select("item", F.col("merged").alias("words")), "item")
    slots = F.filter(F.expr(
        f"array_distinct(flatten(transform(every, p -> transform(sequence(0L, {window - 1}L), j -> struct("
        "p.at + j AS i, get(words, int(p.at + j)) AS item, get(there, int(p.at + p.start + j)) AS doc)))))"),
        lambda p: _is_slot(template_word(p["item"])) & (template_word(p["item"]) == template_word(p["doc"])))
    # A word with a capital before the item isn't part of the name that the item begins with.
    pairs = scratch.keep(both.withColumn("slots", slots), "merged_slots").withColumn("slots", _once("slots", (
        "filter(x, p -> NOT (p.i = 0 AND exists(x, q -> q.i > 0 AND q.item = p.item "
        "AND endswith(p.doc, concat(' ', q.doc)))))")))
    # The place among single words, as elsewhere.
    before = F.expr("IF(every[0].start > 0, slice(there, 1, int(every[0].start)), array())")
    start = F.expr("least(every[0].start, 0) + IF(every[0].start >= 0, lead, 0)") + F.aggregate(
        before, F.lit(0), lambda n, w: n + F.size(F.array_remove(words_of(w), "")))
    return pairs.select(
        "id", "sub", "item", start.alias("start"), "n_matched", "n_windows",
        F.expr("size(array_distinct(slots.i))").alias("n_slots"),
        F.expr("size(array_distinct(filter(slots, p -> p.item <> p.doc).i))").alias("n_changed"),
        F.expr("size(array_distinct(transform(slots, p -> struct(p.item, p.doc)))) = size(array_distinct(slots.item))")
        .alias("consistent"))


def _copies(candidates: DataFrame, texts: DataFrame, items: DataFrame, scratch: Scratch) -> DataFrame:
    """Judged candidates over the words as they are, whatever their case."""
    both = candidates.join(texts, ["id", "sub"]).select("*", literal_words(F.col("text")).alias("there")).drop("text") \
        .join(items.select("item", F.col("literal").alias("words")), "item")
    # A name may stand for any word, as its capital can be lost.
    slots = F.transform(F.filter(F.expr(
        "filter(transform(words, (w, i) -> struct(w AS item, IF(start + i >= 0, get(there, int(start + i)), NULL) AS doc)), "
        "p -> p.doc IS NOT NULL)"), lambda p: _is_slot(template_word(p["item"])) & (
            (template_word(p["item"]) == "<name>") | (template_word(p["item"]) == template_word(F.lower(p["doc"]))))),
        lambda p: F.struct(F.lower(p["item"]).alias("item"), F.lower(p["doc"]).alias("doc")))
    return scratch.keep(both.select("id", "sub", "item", "start", "n_matched", "n_windows", slots.alias("slots")),
                        "literal_slots").select(
        "id", "sub", "item", "start", "n_matched", "n_windows", F.size("slots").alias("n_slots"),
        F.expr("size(filter(slots, p -> p.item <> p.doc))").alias("n_changed"),
        F.expr("size(array_distinct(slots)) = size(array_distinct(slots.item))").alias("consistent"))


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents, with all their columns, that hold no item of the benchmark. Texts are judged one by one, also those
    without an id or with the same one."""
    key = F.struct(*_key())
    leaks = [df.select("id", "sub") for df in _judged(docs, benchmark, WINDOW, PERCENT)]
    leaked = leaks[0].union(leaks[1]).union(leaks[2]).distinct().select(F.struct("id", "sub").alias("leaked"))
    return docs.join(leaked, key == leaked["leaked"], "left_anti").select(*docs.columns)
