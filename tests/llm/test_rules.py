"""Quality rules, decontamination, licenses, chats and urls."""

import json
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from plain import base_counts, empty_documents, odd_documents
from quillvec.llm import chat, licenses, perplexity, templates, urls


@pytest.fixture(scope="module")
def docs(spark):
    return odd_documents(spark, spark.read.parquet(f"{SMALL}/documents.parquet")).cache()


def plain_model(texts):
    """Interpolated modified Kneser-Ney of byte trigrams, as a function of three bytes."""
    full = Counter()
    for t in texts:
        b = b"\n\n" + (t or "").encode()
        full.update(b[i:i + 3] for i in range(len(b) - 2))

    def level(counts):
        n = [max(1, sum(c == k for c in counts.values())) for k in range(1, 5)]
        y = n[0] / (n[0] + 2 * n[1])
        d = [min(max(k - (k + 1) * y * n[k] / n[k - 1], 0.1), k - 0.05) for k in (1, 2, 3)]
        total, left = Counter(), Counter()
        for gram, c in counts.items():
            total[gram[:-1]] += c
            left[gram[:-1]] += d[min(c, 3) - 1]

        def share(gram):
            h, c = gram[:-1], counts.get(gram, 0)
            if h not in total:
                return 0, 1
            return (c - d[min(c, 3) - 1] if c else 0) / total[h], left[h] / total[h]
        return share

    pairs = Counter(g[1:] for g in full)
    single = Counter(g[1:] for g in pairs)
    levels = [level(full), level(pairs), level(single)]

    def probability(gram):
        p = 1 / 256
        for k, share in zip((1, 2, 3), reversed(levels), strict=True):
            a, b = share(gram[3 - k:])
            p = a + b * p
        return p
    return probability


def test_word_rules(docs):
    rows = docs.select("doc_id", "text").collect()
    got = perplexity.quality_rules(docs, carry=("text",)).select(
        "doc_id", "text", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed").collect()
    want = [(r.doc_id, r.text, *base_counts(r.text)) for r in rows]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_bits_are_those_of_the_model(spark):
    texts = ["the cat sat on the mat", "the dog sat", "abc", "z", "", None, "the cat ran on the mat"]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    p = plain_model(texts)
    for r in perplexity.quality_rules(docs, carry=("text",)).collect():
        b = b"\n\n" + (r.text or "").encode()
        logs = [-math.log2(p(b[i:i + 3])) for i in range(len(b) - 2)]
        if not logs:
            assert r.bits is None and not r.kept
        elif len(logs) <= perplexity.PIECE:
            assert r.bits == pytest.approx(sum(logs) / len(logs), abs=1e-4)
            assert r.perplexity == pytest.approx(2 ** r.bits)


def plain_long_model(texts, least=2):
    """The same of five bytes held by two texts, as a function; pairs are those of the short model."""
    padded = [b"\n" * 4 + (t or "").encode() for t in texts]
    held = Counter(g for b in padded for g in {b[i:i + 5] for i in range(len(b) - 4)})
    kept = {g: c for g, c in held.items() if c >= least}
    four = Counter(g[1:] for g in kept)
    three = Counter(g[1:] for g in four)
    triples = Counter(b[i:i + 3] for b in padded for i in range(2, len(b) - 2))
    pairs = Counter(g[1:] for g in triples)
    levels = [(Counter(g[1:] for g in pairs),) * 2, (pairs, pairs), (three, three), (four, four), (kept, held)]

    def probability(gram):
        p = 1 / 256
        for k, (counts, seen) in enumerate(levels, 1):
            n = [max(1, sum(c == m for c in seen.values())) for m in range(1, 5)]
            y = n[0] / (n[0] + 2 * n[1])
            d = [min(max(m - (m + 1) * y * n[m] / n[m - 1], 0.1), m - 0.05) for m in (1, 2, 3)]
            mine = gram[5 - k:]
            after = {g: c for g, c in counts.items() if g[:-1] == mine[:-1]}
            if after:
                c = counts.get(mine, 0)
                total = sum(after.values())
                p = (c - d[min(c, 3) - 1] if c else 0) / total + sum(d[min(c, 3) - 1] for c in after.values()) / total * p
        return p
    return probability


def test_long_bits_are_those_of_the_model(spark):
    texts = ["the cat sat on the mat", "the dog sat", "abc", "z", "", None, "the cat ran on the mat", "the dog sat"]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    p = plain_long_model(texts)
    for r in perplexity.quality_rules(docs, carry=("text",)).collect():
        b = b"\n" * 4 + (r.text or "").encode()
        logs = [-math.log2(p(b[i:i + 5])) for i in range(len(b) - 4)]
        assert r.long_bits is None if not logs else r.long_bits == pytest.approx(sum(logs) / len(logs), abs=1e-4)


def some_shard(alphabet=8, size=4000):
    rng = np.random.default_rng(1)
    codes = np.zeros(size, np.uint64)
    for k in range(5):
        codes |= rng.integers(97, 97 + alphabet, size).astype(np.uint64) << np.uint64(8 * k)
    codes, counts = np.unique(codes, return_counts=True)
    short, after = np.unique(codes & perplexity.MASKS[3] & perplexity.MASKS[2], return_counts=True)
    given = [perplexity.discounts_of(np.array([9, 5, 3, 2]))] * 4
    return perplexity.shard_arrays(codes, counts, counts + 1, perplexity.pair_probabilities(short, after), given)


def test_models_sum_to_one():
    shard = some_shard()
    for context in (0x61616161, 0x62616361, 0x62630102, 0x01020304):
        codes = (np.uint64(context) << np.uint64(8)) + np.arange(256, dtype=np.uint64)
        for cost in perplexity.costs(shard, codes):
            assert np.exp2(-cost / perplexity.SCALE).sum() == pytest.approx(1, abs=1e-4)


def test_long_texts_are_read_as_their_parts(monkeypatch):
    """Codes, counts and costs of a text that comes in parts are those of the text in one."""
    models = perplexity.Models([], {"en": 0.1}, 1, True)
    models.held = {"en": {0: some_shard()}}
    data = np.random.default_rng(3).integers(97, 106, 5000).astype(np.uint8)
    at = np.array([0, len(data)])

    def found():
        codes = np.concatenate([c for c, _ in perplexity.sequences(data, at)])
        return [codes, *perplexity._text_counts(data, at), models.own(data, at, ["en"]), models.best(data, at, ["en"])]
    want = found()
    monkeypatch.setattr(perplexity, "SEGMENT", 16 * perplexity.PIECE)
    assert len(list(perplexity.sequences(data, at))) == 5
    for x, y in zip(found(), want, strict=True):
        assert (x == y).all()
    _, n, texts = perplexity._text_counts(np.r_[data, data], np.array([0, 0, len(data), len(data), 2 * len(data)]))
    assert n.sum() == 2 * len(data) and set(texts) == {2}


def test_odd_texts_do_not_explain_themselves(spark):
    """Random letters cost nearly as much as they do without a model, however long the text."""
    rng = np.random.default_rng(4)
    rows = [(i, " ".join(rng.choice(["the", "cat", "sat", "on", "a", "mat"], 60)), "en") for i in range(50)]
    rows.append((99, " ".join("".join(map(chr, rng.integers(97, 123, 9))) for _ in range(400)), "en"))
    got = {r.doc_id: r for r in perplexity.quality_rules(
        spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert got[99].long_bits > 4 and not got[99].kept and sum(got[i].kept or got[i].base_failed for i in range(50)) >= 48


def test_bands_reject_noise_and_keep_passages_in_other_languages(spark):
    rng = np.random.default_rng(2)
    words = {"en": ["the", "and", "thing", "other", "with"], "de": ["und", "schön", "nicht", "über", "doch"]}
    say = {k: lambda n, v=v: " ".join(rng.choice(v) + rng.choice(v) for _ in range(n)) for k, v in words.items()}
    rows = [(i, say[lang](120), lang) for i, lang in enumerate(["en", "de"] * 60)]
    rows.append((1000, say["en"](80) + " " + say["de"](80), "en"))
    rows.append((1001, " ".join("".join(map(chr, rng.integers(33, 126, 8))) for _ in range(120)), "en"))
    got = {r.doc_id: r.kept for r in perplexity.quality_rules(
        spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert not got[1001] and got[1000] and all(got[i] for i in range(120))


def test_models_in_groups_give_all_rows_the_same(docs, monkeypatch):
    want = sorted(map(tuple, perplexity.quality_rules(docs, carry=("text",)).collect()), key=repr)
    monkeypatch.setattr(perplexity, "SHARD_KEYS", 40_000)
    assert sorted(map(tuple, perplexity.quality_rules(docs, carry=("text",)).collect()), key=repr) == want
    monkeypatch.setattr(perplexity, "MODEL_BYTES", 2 << 20)
    passes = []
    monkeypatch.setattr(perplexity, "_own_costs", lambda m, f=perplexity._own_costs: passes.append(1) or f(m))
    assert sorted(map(tuple, perplexity.quality_rules(docs, carry=("text",)).collect()), key=repr) == want
    assert len(passes) > 1


def test_bands_on_labelled_rows(spark):
    """Most rows labelled bad that pass the word rules go, nearly all rows labelled good stay."""
    sf = SMALL.replace("sf0.001", "sf0.01")
    labels = spark.read.parquet(f"{sf}/labels.parquet").filter("quality IS NOT NULL").select("doc_id", "quality")
    judged = perplexity.quality_rules(spark.read.parquet(f"{sf}/documents.parquet")).filter("NOT base_failed")
    got = {(r.quality, r.kept): r["count"] for r in judged.join(labels, "doc_id").groupBy("quality", "kept").count().collect()}
    assert got.get((0, True), 0) <= 0.5 * sum(n for (q, _), n in got.items() if q == 0)
    assert got.get((1, False), 0) <= 0.04 * sum(n for (q, _), n in got.items() if q == 1)


# -- decontamination ------------------------------------------------------------------------------------------------

ITEM = "Anna has 3 apples and buys 4 more apples at the market, how many apples does Anna hold after 3 days there?"


def judged(spark, *texts, item=ITEM):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame([(7, item), (8, None), (9, "too short")], "item_id long, text string")
    return {r.doc_id: r for r in templates.leaked_items(docs, bench).collect()}


def test_slots_decide(spark):
    got = judged(
        spark, ITEM, ITEM.replace("Anna", "Berta").replace("3", "17").replace("4", "99"),
        ITEM.replace("Anna has", "Berta has"), ITEM.replace("3 days", "5 days"),
        "Before it. " + ITEM + " After it.", "Nothing of the kind is said in this text at all, it is about 3 apples.", None, "")
    assert {k: r.kind for k, r in got.items()} == {0: "copy", 1: "reparameterised", 4: "copy"}
    assert got[1].n_changed == 5 and got[1].n_slots == got[0].n_slots and got[4].start == 2


def test_units_are_placeholders(spark):
    got = judged(spark, ITEM.replace("days", "weeks"))
    assert got[0].kind == "reparameterised" and got[0].n_changed == 1


def test_most_of_an_item_is_enough(spark):
    words = ITEM.split()
    got = judged(spark, " ".join(words[3:]), " ".join(words[8:]))
    assert set(got) == {0} and got[0].start == -3


def test_slots_of_other_lengths_and_joints(spark):
    got = judged(
        spark, ITEM.replace("4", "4.5"), ITEM.replace("4", "1,200"), ITEM.replace("Anna", "Mary Ann"),
        ITEM.replace("buys", "then buys"), ITEM.replace("how many apples", "how many"),
        "Now " + ITEM.replace("4", "-4.5"), ITEM.replace("Anna has", "Mary Ann has"),
        ITEM.replace("buys", "then buys").replace("3 days", "5 days"), " ".join(ITEM.replace("4", "4.5").split()[8:]))
    assert {k: (r.kind, r.n_changed) for k, r in got.items()} == {
        0: ("reparameterised", 1), 1: ("reparameterised", 1), 2: ("reparameterised", 2), 3: ("copy", 0), 4: ("copy", 0),
        5: ("reparameterised", 1)}
    assert got[5].start == 0 and got[3].n_matched == got[3].n_windows == 17


def test_copies_without_countable_windows(spark):
    items = {1: "Is Rome old?", 2: ITEM.title(), 3: "2 4 8 16 32 64 128 or 256", 4: "小明有3个苹果,又买了4个,现在他一共有多少个苹果?"}
    bench = spark.createDataFrame([*items.items(), (7, ITEM), (8, "?!"), (9, None)], "item_id long, text string")
    texts = ["He asked: is Rome OLD? Yes.", "x " + items[2], "see 2 4 8 16 32 64 128 or 256.", "问题" + items[4] + "答案",
             ITEM.lower(), ITEM.upper(), ITEM.lower().replace("anna has", "berta has"), "Is Rome new? ?!",
             items[4].replace("4", "17")]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {(r.doc_id, r.item_id, r.kind) for r in templates.leaked_items(docs, bench).collect()}
    assert got == {(0, 1, "copy"), (1, 2, "copy"), (1, 7, "copy"), (2, 3, "copy"), (3, 4, "copy"), (4, 2, "copy"),
                   (4, 7, "copy"), (5, 2, "copy"), (5, 7, "copy"), (8, 4, "reparameterised")}


def test_leaks_in_odd_documents(spark, docs):
    bench = spark.read.parquet(f"{SMALL}/benchmark.parquet").withColumn("id", F.lit(1)).withColumn("words", F.lit(2))
    got = {(r.doc_id, r.item_id) for r in templates.leaked_items(docs, bench).collect()}
    want = {(d.doc_id, b.item_id) for d in docs.collect() for b in bench.collect() if d.text and b.text in d.text}
    assert want <= got and want
    kept = templates.without_leaks(docs, bench)
    assert kept.columns == docs.columns
    assert kept.count() == docs.count() - docs.filter(F.col("doc_id").isin([d for d, _ in got])).count()


def test_leaks_without_ids(spark):
    bench = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    rows = [(None, "x " + ITEM), (None, "a clean text"), (None, None), (3, ITEM), (3, "another text"), (3, ITEM)]
    docs = spark.createDataFrame([(*r, "e") for r in rows], "doc_id long, text string, leaked string")
    got = templates.leaked_items(docs, bench).collect()
    assert {(r.doc_id, r.n_matched, r.n_windows) for r in got} == {(None, 17, 17), (3, 17, 17)} and len(got) == 2
    kept = templates.without_leaks(docs, bench).collect()
    assert sorted((str(r.doc_id), r.text) for r in kept if r.text) == [("3", "another text"), ("None", "a clean text")]
    assert len(kept) == 3


def test_merged_words_by_replacement(spark):
    """The quick way of the scan gives the words that the pattern gives."""
    random.seed(6)
    some = ["a", "B", "Anna", "Bob", "iPhone", "4", "4.5", "1,200", "-", "+", ".", ",", " ", " ", "'", "’", "_", "kg", "mL",
            "é", "É", "\n", "٣", "Ⅷ", "x4", "4x", "\t", "(", "²", "—"]
    texts = ["".join(random.choices(some, k=random.randint(0, 25))) for _ in range(3000)] + [None, "", "中 Anna 4.5 文"]
    df = spark.createDataFrame(list(enumerate(texts)), "k long, text string")
    rows = templates._windows(df, ["k"], templates.words_of(F.col("text")), templates.literal_words(F.col("text")), 1, [])
    quick = rows.filter(f"reading = {templates.LOOSE}").groupBy("k").count()
    plain = df.select("k", F.transform(templates.merged_words(F.col("text")), templates.template_word).alias("w"))
    plain = plain.select("k", F.size(F.filter("w", lambda w: ~w.isin("<num>", "<name>", "<unit>"))).alias("n"))
    assert templates.PLAIN_WORDS > 1 and quick.count() == 0  # such windows say too little
    replaced = F.regexp_replace(F.regexp_replace("text", templates.NUMBER, " 0 "), templates.NAMES, " 1 ")
    words = F.array_remove(F.split(replaced, r"[^\p{L}\p{N}]+"), "")
    both = df.select("k", "text", F.transform(words, lambda w: F.when(w == "0", "<num>").when(w == "1", "<name>")
                                              .otherwise(w)).alias("quick"),
                     F.transform(templates.merged_words(F.col("text")), lambda w: F.when(
                         templates.template_word(w).isin("<num>", "<name>") & ~F.substring(w, 1, 1).isin("Ⅷ"),
                         templates.template_word(w)).otherwise(w)).alias("slow")).filter("text NOT LIKE '%中%'")
    assert both.filter("NOT quick <=> slow").collect() == []
    assert plain.count() == len(texts)


def test_leaks_without_rows(spark):
    bench = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    assert templates.leaked_items(empty_documents(spark), bench).count() == 0
    assert templates.leaked_items(bench.select(F.col("item_id").alias("doc_id"), "text"), bench.limit(0)).count() == 0


def test_leaks_by_shuffle(spark, docs, monkeypatch):
    bench = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    want = sorted(map(tuple, templates.leaked_items(docs, bench).collect()), key=repr)
    monkeypatch.setattr(templates, "sized", lambda df: df)
    assert sorted(map(tuple, templates.leaked_items(docs, bench).collect()), key=repr) == want


# -- licenses ---------------------------------------------------------------------------------------------------------

def test_notices_wherever_they_stand(spark):
    table = licenses.template_table(spark)
    rows, want = [], set()
    for i, (_, notice) in enumerate(licenses.TEMPLATES):
        for shift in range(7):
            doc = i * 10 + shift
            rows.append((doc, " ".join(f"x{doc}y{j}" for j in range(shift)) + f"\n({notice.upper()})\nmore words here"))
            want.add((doc, i))
    rows += [(900, None), (901, ""), (902, "the license"), (903, "free of charge, to any person"), (None, rows[0][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("template", F.lit(1))
    got = {(r.doc_id, r.template) for r in licenses.found_licenses(docs, table).collect()}
    assert got == want | {(None, 0)}
    assert licenses.found_licenses(docs.limit(0), table).count() == 0
    assert licenses.found_licenses(docs, table.limit(0)).count() == 0


def test_changed_notice(spark):
    notice = licenses.TEMPLATES[6][1].split()
    docs = spark.createDataFrame([(1, " ".join([*notice[:9], "other", *notice[10:]])), (2, " ".join(notice[::2]))],
                                 "doc_id long, text string")
    got = licenses.found_licenses(docs, licenses.template_table(spark)).collect()
    assert [(r.doc_id, r.template) for r in got] == [(1, 6)] and 0.8 <= got[0].containment < 1


# -- chats ------------------------------------------------------------------------------------------------------------

def test_calls_are_linked_checked_and_ordered(spark):
    schema = {"add": {"a": chat.Field("number"), "b": chat.Field("number"), "note": chat.Field("string", False, 5)}}
    messages = [
        (1, 1, "assistant", json.dumps({"tool_calls": [
            {"id": "p", "name": "add", "arguments": {"b": 2, "a": 1}}, {"id": "q", "name": "add", "arguments": {"a": "x"}},
            {"id": "r", "name": "mul", "arguments": {}}, {"id": "s", "name": "add",
                                                       "arguments": {"b": 1, "a": 2, "note": "too long", "z": 0}}]})),
        (1, 0, "tool", json.dumps({"tool_call_id": "p", "content": {"y": [1, {"d": 1, "c": 2}], "x": "é\n"}})),
        (1, 2, "tool", json.dumps({"tool_call_id": "nobody", "content": "lost"})),
        (1, 3, "assistant", json.dumps({"tool_calls": [{"id": "p", "name": "add", "arguments": {"a": 5, "b": 5}}]})),
        (2, 2, "tool", json.dumps({"tool_call_id": "p", "content": 1})),
    ]
    table = spark.createDataFrame(messages, "conv_id long, turn long, role string, text string") \
        .withColumn("level", F.lit(1)).withColumn("status", F.lit("x"))
    rows = chat.linked_calls(*chat.calls_and_results(table), schema).orderBy("conv_id", "level", "call_id", "step").collect()
    got = [(r.conv_id, r.level, r.call_id, r.kind, r.status, r.errors) for r in rows]
    assert got == [
        (1, 1, "p", "call", "answered", ""), (1, 1, "p", "result", "linked", ""),
        (1, 1, "q", "call", "invalid", "a is no number; missing b"),
        (1, 1, "r", "call", "invalid", "unknown function"),
        (1, 1, "s", "call", "invalid", "note is too long; unknown z"),
        (1, 2, "nobody", "result", "orphan", ""), (1, 3, "p", "call", "repeated", ""),
        (2, 2, "p", "result", "orphan", "")]
    assert rows[0].json == '{"arguments":{"a":1,"b":2},"call_id":"p","conv_id":1,"name":"add","turn":1,"type":"call"}'
    assert rows[1].json == ('{"call_id":"p","content":{"x":"é\\n","y":[1,{"c":2,"d":1}]},"conv_id":1,"turn":0,'
                            '"type":"result"}')


def test_no_message_is_lost(spark):
    call = {"id": "p", "name": "add", "arguments": {"a": 1}}
    messages = [
        (1, 1, "assistant", json.dumps({"tool_calls": [], "content": "hello"})),
        (1, 3, "assistant", json.dumps({"tool_calls": [call], "content": "I will add"})),
        (1, 5, "user", json.dumps({"tool_calls": []})), (1, 7, "assistant", json.dumps({"tool_calls": None, "content": 1})),
        (1, 9, "tool", " \n" + json.dumps({"tool_call_id": "p", "content": {"x": 1}})),
        (1, 11, "tool", json.dumps({"tool_call_id": "p", "content": 2, "tool_calls": [call]})),
        (1, 13, "assistant", json.dumps({"tool_calls": [], "content": {"y": 2}})), (1, 15, "assistant", "{"), (1, 17, "user", "")]
    table = spark.createDataFrame(messages, "conv_id long, turn long, role string, text string")
    calls, results = chat.calls_and_results(table)
    assert {(r.turn, r.call_id, r.arguments) for r in calls.collect()} == {
        (3, "p", '{"a":1}'), (5, "turn-5", '{"text":"{\\"tool_calls\\": []}"}'), (11, "p", '{"a":1}'), (17, "turn-17", '{"text":""}')}
    found = {(r.turn, r.call_id): json.loads(r.content) for r in results.collect()}
    assert found == {(1, "turn-0"): {"text": "hello"}, (3, "turn-2"): {"text": "I will add"},
                     (7, "turn-6"): {"text": messages[3][3]}, (9, "p"): {"x": 1}, (11, "p"): 2,
                     (13, "turn-12"): {"text": '{"y":2}'}, (15, "turn-14"): {"text": "{"}}


def test_odd_messages(spark):
    messages = [(None, 0, "user", "a"), (None, 1, "assistant", "b"), (3, None, "user", "c"), (3, None, "assistant", "d"),
                (4, 0, None, None), (4, 0, "user", "{not json"), (5, 0, "user", "x"), (5, 0, "user", "x"),
                (5, 1, "assistant", "y"), (6, 0, "user", "z" * 200_000)]
    table = spark.createDataFrame(messages, "conv_id long, turn long, role string, text string")
    rows = chat.linked_calls(*chat.calls_and_results(table), chat.TURN_SCHEMAS).collect()
    got = sorted(((r.conv_id, r.turn, r.kind, r.status, r.errors) for r in rows), key=repr)
    assert got == sorted([
        (None, 0, "call", "answered", ""), (None, 1, "result", "linked", ""), (3, None, "call", "unanswered", ""),
        (3, None, "result", "orphan", ""), (4, 0, "call", "invalid", "missing text"), (4, 0, "call", "unanswered", ""),
        (5, 0, "call", "answered", ""), (5, 0, "call", "answered", ""), (5, 1, "result", "linked", ""),
        (6, 0, "call", "unanswered", "")], key=repr)
    for r in rows:
        whole = json.loads(r.json)
        assert r.json == json.dumps(whole, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    assert chat.linked_calls(*chat.calls_and_results(table.limit(0)), chat.TURN_SCHEMAS).count() == 0


# -- urls ---------------------------------------------------------------------------------------------------------------

def test_hosts_paths_and_rules(spark):
    cases = {
        "http://A.Example.COM/en/x?q#f": ("a.example.com", "/en/x", "example.com/en/", "block"),
        "https://www.example.com/en/": ("www.example.com", "/en/", "www.example.com/en/", "allow"),
        "https://m.www.example.com/en/É": ("m.www.example.com", "/en/É", "www.example.com/en/", "allow"),
        "http://x.com/de": ("x.com", "/de", "com/", "allow"), "http://x.com": ("x.com", "", None, None),
        "http://x.com?a=/en/": ("x.com", "", None, None), "http://x.net/es/#a": ("x.net", "/es/", "net/es/", "block"),
        "http://xnet/es/": ("xnet", "/es/", None, None), "ÀB://É.net/fr/1": ("É.net", "/fr/1", "net/fr/", "block"),
        "a://b://c.com/": ("b:", "//c.com/", None, None), "no scheme": ("", "", None, None), "": ("", "", None, None),
        "http://com/": ("com", "/", "com/", "allow"), None: ("", "", None, None), "x\n://h.com/p": ("h.com", "/p", "com/", "allow"),
    }
    pages = spark.createDataFrame([(i, u, None) for i, u in enumerate(cases)], "page_id long, url string, html string") \
        .withColumn("token", F.lit(1)).withColumn("host", F.lit("x"))
    rows = {r.page_id: r for r in urls.judged_urls(pages).collect()}
    for i, (host, path, rule, verdict) in enumerate(cases.values()):
        r = rows[i]
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == verdict if rule else r.verdict in ("allow", "block")
        assert (r.score is None) == (rule is not None)


def test_names_are_split_into_words():
    counts = {"free": 50, "bets": 40, "be": 5, "ts": 1, "freeb": 1}

    def split(token, total=1000):
        known = {(i, j): counts[token[i:j]] for i in range(len(token)) for j in range(i + 1, len(token) + 1)
                 if token[i:j] in counts}
        return urls.best_split(token, known, total)
    assert split("freebets") == ["free", "bets"]
    assert split("betsfreebets") == ["bets", "free", "bets"]
    assert split("q" * 27) == ["q" * 27] and urls.best_split("q" * 30_000, {}, 1000) == ["q" * 30_000]
    assert split("free" + "q" * 27 + "bets") == ["free", "q" * 27, "bets"]
    assert split("free", 0) == ["free"] or "".join(split("free", 0)) == "free"


def test_splits_are_the_most_probable_ones():
    rng = random.Random(3)

    def score(words, counts, total):
        return sum(math.log(counts[w] / total) if w in counts else math.log(10 / total) - len(w) * math.log(10) for w in words)
    for _ in range(200):
        token = "".join(rng.choice("ab") for _ in range(rng.randrange(1, 11)))
        counts = {token[i:j]: rng.randrange(1, 60) for i in range(len(token)) for j in range(i + 1, len(token) + 1)
                  if rng.random() < 0.3}
        total = rng.randrange(60, 4000)
        known = {(i, j): counts[token[i:j]] for i in range(len(token)) for j in range(i + 1, len(token) + 1)
                 if token[i:j] in counts}
        splits = [[]]
        for i in range(1 << (len(token) - 1)):
            cuts = [0, *[k for k in range(1, len(token)) if i >> (k - 1) & 1], len(token)]
            splits.append([token[a:b] for a, b in zip(cuts, cuts[1:])])
        best = max(score(x, counts, total) for x in splits[1:])
        got = urls.best_split(token, known, total)
        assert "".join(got) == token and score(got, counts, total) == pytest.approx(best)


def test_long_words_are_words(spark):
    """Words of any length are counted and found in names; very long urls are judged."""
    long = "administrationsgerichtsbarkeit"
    rows = [(i, f"http://{long}{'spiele' * 2}.org/x", f"<p>{long} spiele</p>") for i in range(9)]
    rows.append((10, "http://a.com/" + "abc" * 2_000, None))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    counts = urls.word_counts(pages)
    assert {r.word: r.n for r in counts.collect()} == {long: 9, "spiele": 9}
    tokens = spark.createDataFrame([(long + "spiele" * 2,), ("z" * 40,), ("abc" * 2_000,)], "token string")
    got = {r.token: r.words for r in urls.segmented(tokens, counts).collect()}
    assert got[long + "spiele" * 2] == [long, "spiele", "spiele"] and got["z" * 40] == ["z" * 40]
    assert len(got["abc" * 2_000]) == 1 and urls.judged_urls(pages).count() == 10


def test_words_far_apart(spark):
    """Any number of tags and other characters may lie between two words; a ``<`` that no ``>`` ends is one of these."""
    between = ["<b>1 " * 30_000, " éè" * 50_000, "<br/>" * 50_000, "< é" * 300, "<" + "é" * 100_000 + ">", "x" * 50_000]
    pages = spark.createDataFrame([(i, f"http://abc{i}.org/x", f"abc{s}def<i") for i, s in enumerate(between)],
                                  "page_id long, url string, html string")
    want = Counter(w for s in between for w in re.split(r"(?:<[^>]*>|[^a-z])+", f"abc{s}def<i") if w)
    assert {r.word: r.n for r in urls.word_counts(pages).collect()} == want
    assert urls.judged_urls(pages).count() == len(between)


def test_urls_against_a_plain_model(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    pages = pages.unionByName(pages.limit(5)).unionByName(pages.limit(1).select(F.lit(None).cast("long").alias("page_id"),
                                                                                "url", "html"))
    got = urls.judged_urls(pages).collect()
    assert len(got) == pages.count()
    rows = pages.collect()
    import re
    count = Counter(w for r in rows for w in re.split(r"(?:<[^>]*>|[^a-z])+", r.html.lower()) if w)
    total = sum(count.values())

    def parts(host, path):
        text = re.sub("[0-9]+", " 0 ", (host + "/" + path).lower())
        out = []
        for t in re.findall("[a-z0]+", text):
            known = {(i, j): count[t[i:j]] for i in range(len(t)) for j in range(i + 1, len(t) + 1)
                     if t[i:j] in count}
            out += urls.best_split(t, known, total)
        return out
    seen, number = {"allow": Counter(), "block": Counter()}, Counter()
    for r in got:
        if r.rule:
            seen[r.verdict].update(parts(r.host, r.path))
            number[r.verdict] += 1
    every = {w for r in got for w in parts(r.host, r.path)}
    size = {k: sum(v.values()) + len(every) for k, v in seen.items()}
    for r in got:
        if not r.rule:
            odds = math.log(number["block"] / number["allow"]) + sum(
                math.log((seen["block"][w] + 1) / size["block"]) - math.log((seen["allow"][w] + 1) / size["allow"])
                for w in parts(r.host, r.path))
            assert r.score == pytest.approx(odds, abs=1e-5)
            assert r.verdict == ("block" if odds > 0 else "allow") or abs(odds) < 1e-6


def test_no_pages(spark):
    assert urls.judged_urls(spark.read.parquet(f"{SMALL}/pages.parquet").limit(0)).count() == 0
