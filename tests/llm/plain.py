"""Plain versions of the operators, and a small table with all odd cases."""

import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
PASSAGE = " ".join(f"common{i}" for i in range(60))


def odd_documents(spark, base=None):
    """Texts that are NULL, empty, white, very long, equal or nearly so; ids that are NULL or given twice; and columns
    with the names that operators use inside."""
    long = " ".join(f"w{i * i % 9973}" for i in range(40_000))
    twin = " ".join(f"t{i}" for i in range(200))
    rows = [
        (1, None, "en"), (2, "", "en"), (3, " \t\n ", None), (4, long, "en"), (5, twin, "de"), (6, twin, "de"),
        (7, twin + " more", "de"), (8, "one two", "fr"), (8, "one two", "fr"), (9, "One TWO", "fr"),
        (10, "début " + PASSAGE + " fin été", "fr"), (11, "other words " + PASSAGE + "\nend", "fr"),
        (None, "a text without an id " + PASSAGE, "es"), (12, "x" * 3000, "es"), (13, "x" * 3000 + "é", "es"),
        (14, "same " * 300, "en"), (8, "another text with the same id", "en"), (None, twin, None),
    ]
    df = spark.createDataFrame([(i, t, lang, "src", len(t or "")) for i, t, lang in rows],
                               "doc_id long, text string, lang string, source string, n_chars long")
    if base is not None:
        df = base.select(*df.columns).withColumn("doc_id", F.col("doc_id") + 100).unionByName(df)
    return df.withColumns({"id": F.lit("x"), "sub": F.lit(1), "key": F.lit(2), "row": F.lit(3), "n": F.lit(4),
                           "kept": F.lit(True), "spans": F.lit("s"), "node": F.lit(5), "bits": F.lit(0.5)})


def empty_documents(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


def words(text):
    return WORD.findall(text or "")


def without_passages(rows, size=13):
    """(id, text) -> (words, removed, rest)"""
    last = 2**63 - 1
    first = {}
    for doc, text in rows:
        w = words(text)
        for i in range(len(w) - size + 1):
            k = tuple(w[i:i + size])
            first[k] = min(first.get(k, last), last if doc is None else doc)
    out = []
    for doc, text in rows:
        w = words(text)
        gone = set()
        for i in range(len(w) - size + 1):
            if first[tuple(w[i:i + size])] < (last if doc is None else doc):
                gone.update(range(i, i + size))
        out.append((doc, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def without_strings(rows, size=400):
    """(id, text) -> (bytes, removed, spans, rest)"""
    count = Counter()
    data = [(doc, (text or "").encode()) for doc, text in rows]
    for _, b in data:
        count.update(b[i:i + size] for i in range(len(b) - size + 1))
    out = []
    for doc, b in data:
        gone = bytearray(len(b))
        for i in range(len(b) - size + 1):
            if count[b[i:i + size]] > 1:
                gone[i:i + size] = b"\1" * size
        spans = sum(1 for i in range(len(gone)) if gone[i] and (not i or not gone[i - 1]))
        out.append((doc, len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone, strict=True) if not g)))
    return out


def shingles(text, size=3):
    w = words((text or "").translate(LOWER))
    if len(w) < size:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(tuple(w[i:i + size]) for i in range(len(w) - size + 1))


def components(rows, size=3, percent=90):
    """(id, text) -> (set size, smallest linked id), by comparing every two sets."""
    sets = [shingles(t, size) for _, t in rows]
    label = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= percent * (len(sets[a]) + len(sets[b]) - shared) and label[a] != label[b]:
                label = [label[b] if x == label[a] else x for x in label]
    least = defaultdict(lambda: None)
    for i, (doc, _) in enumerate(rows):
        if doc is not None and (least[label[i]] is None or doc < least[label[i]]):
            least[label[i]] = doc
    return [(doc, len(sets[i]), least[label[i]] if sets[i] else doc) for i, (doc, _) in enumerate(rows)]


def base_counts(text):
    text = text or ""
    w = words(text)
    seen = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    inside = {i + j for i in range(len(w) - 2) if seen[tuple(w[i:i + 3])] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(w) < 50 or 100 * len(inside) > 50 * len(w)
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside),
            failed)
