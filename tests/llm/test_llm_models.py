"""Language identification and importance resampling: exact against brute force where they are, held-out accuracy where they learn."""

import itertools
import math
import random
from collections import Counter

import edge
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from cartwright.llm import importance, language

LABELS = "doc_id bigint, quality int, toxic int, text string"


def enumerate_chain(scores, transitions):
    """Marginals and pair sums by going through all labellings."""
    steps, labels = scores.shape
    marginals, pairs, total = np.zeros_like(scores), np.zeros_like(transitions), 0.0
    for path in itertools.product(range(labels), repeat=steps):
        weight = math.exp(
            sum(scores[i, k] for i, k in enumerate(path)) + sum(transitions[a, b] for a, b in itertools.pairwise(path))
        )
        total += weight
        for i, k in enumerate(path):
            marginals[i, k] += weight
        for a, b in itertools.pairwise(path):
            pairs[a, b] += weight
    return marginals / total, pairs / total


def test_forward_backward_equals_enumeration():
    chance = np.random.default_rng(1)
    lengths, transitions = np.array([3, 1, 5, 2, 5]), chance.normal(size=(3, 3))
    scores = chance.normal(size=(lengths.sum(), 3)) * 3
    found, pairs = language.forward_backward(scores, lengths, transitions)
    at, wanted_pairs = 0, np.zeros((3, 3))
    for length in lengths:
        marginals, own = enumerate_chain(scores[at : at + length], transitions)
        assert np.allclose(found[at : at + length], marginals)
        wanted_pairs += own
        at += length
    assert np.allclose(pairs, wanted_pairs)


def test_word_features_do_not_depend_on_company():
    words = ["a", "straße", "x" * 60, "der", "日本語", ""]
    together = language.word_features(words)
    for i, word in enumerate(words):
        alone = language.word_features([word])
        assert [f for f in together[i] if f < language.BUCKETS] == [f for f in alone[0] if f < language.BUCKETS]


SPEECH = {
    "en": "the and that with this from have not was they which there would about into other".split(),
    "de": "der die und nicht mit sich auf eine auch werden wurde nach über haben einem zwischen".split(),
    "fr": "les des une dans pour que qui sur avec plus être cette comme mais nous leur".split(),
}


def speech(count, seed):
    chance = random.Random(seed)
    return [(i, " ".join(chance.choices(SPEECH[lang], k=chance.randint(3, 60))), lang) for i in range(count) for lang in [chance.choice(list(SPEECH))]]


@pytest.fixture(scope="module")
def spoken(spark):
    return spark.createDataFrame(speech(600, 3), "doc_id bigint, text string, lang string")


def test_language_of_held_out_documents(spark, spoken):
    found = language.identify(spoken).join(spoken, "doc_id").collect()
    held = [row for row in found if row.held_out]
    import zlib

    assert all(row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 3 == 1) for row in found)
    assert len(held) > 100 and sum(row.lang == row.lang_pred for row in held) / len(held) > 0.97
    assert all(0 <= row.score <= 1 for row in found)


def test_labels_of_the_held_out_fold_are_not_learned(spoken):
    wrong = spoken.withColumn("lang", F.when(language.third_of(F.col("doc_id")), "xx").otherwise(F.col("lang")))
    assert edge.rows(language.identify(wrong)) == edge.rows(language.identify(spoken))


def test_text_that_switches_is_labelled_word_by_word(spoken):
    model = language.train(spoken)
    text = " ".join(SPEECH["de"][:8] + SPEECH["fr"][:8] + SPEECH["en"][:8])
    labels = [label for _, label in language.label_words(model, text)]
    assert labels == ["de"] * 8 + ["fr"] * 8 + ["en"] * 8


def test_every_character_of_text_without_spaces_counts():
    chance = random.Random(5)
    signs = {"aa": "日本語文字", "bb": "กขคงจ"}
    rows = [(lang, ["".join(chance.choices(letters, k=300))]) for lang, letters in signs.items() for _ in range(40)]
    rows += [("en", [" ".join(chance.choices(SPEECH["en"], k=50))]) for _ in range(40)]
    model = language.fit(rows)
    passage = "".join(chance.choices(signs["aa"], k=2000))
    edges = "".join(chance.choices(signs["bb"], k=12))
    texts = [f"{passage} the which", f"the which {passage}", f"{edges}{passage}{edges}", passage]
    assert [lang for lang, _ in language.predict_texts(model, texts)] == ["aa"] * 4
    assert sum(len(word) for word, _ in language.label_words(model, texts[2])) == 2024


def test_every_language_is_learned(spark):
    chance = random.Random(9)
    rows = []
    for n in range(70):
        words = ["".join(chance.choices("abcdefghijklmnopqrstuvwxyz", k=6)) for _ in range(12)]
        rows += [(100 * n + i, " ".join(chance.choices(words, k=20)), f"l{n:02}") for i in range(12 if n < 64 else 9)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    assert len({lang for lang, _ in language.train_rows(docs, F.lit(False))}) == 70
    model = language.train(docs, F.lit(False))
    answers = language.predict_texts(model, [text for _, text, _ in rows])
    right = [lang == wanted for (lang, _), (_, _, wanted) in zip(answers, rows, strict=True)]
    assert sum(right) >= 0.95 * len(rows) and sum(right[-54:]) >= 0.95 * 54


@pytest.mark.parametrize("hot", [None, 3])
def test_training_takes_a_quota_per_language_whatever_the_ids(spark, monkeypatch, hot):
    monkeypatch.setattr(language, "DOCS_PER_LANGUAGE", 50)
    monkeypatch.setattr(language, "SAMPLE", 100)
    rows = [(hot, f"hot number {i}", "en") for i in range(3000)] + [(hot, "copy", "en")] * 3000
    rows += [(i, f"mot numéro {i}", "fr") for i in range(100, 1100)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    found = language.train_rows(docs.repartition(3), F.lit(False))
    assert found == language.train_rows(docs.repartition(7), F.lit(False))
    assert [sum(lang == name for lang, _ in found) for name in ("en", "fr")] == [50, 50]
    assert sum(text == "copy" for _, text in found) <= 1
    few = language.train_rows(docs.filter("lang = 'fr'").limit(20), F.lit(False))
    assert len(few) == 20


def test_awkward_documents_have_a_language_or_none(spark):
    found = {}
    for row in language.identify(edge.docs(spark)).collect():
        found.setdefault(row.doc_id, []).append((row.lang_pred, row.held_out))
    assert {found[i][0][0] for i in (3, 4, 5, 11)} == {"und"} and found[1][0][0] == "en" and len(found[14]) == 2
    assert len(found[None]) == 2 and not found[None][0][1]
    assert language.identify(edge.docs(spark, [])).count() == 0
    nothing = language.identify(edge.docs(spark).withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(row.lang_pred, row.score) for row in nothing} == {("und", 0.0)}


def test_language_stage(spark):
    docs = edge.docs(spark)
    stay = language.keep_identified(docs)
    assert stay.columns == docs.columns
    gone = {3, 4, 5, 11}
    assert sorted(row.doc_id for row in stay.collect() if row.doc_id is not None) == sorted(
        i for i, _ in edge.TEXTS if i is not None and i not in gone
    )
    assert language.keep_identified(edge.docs(spark, [])).count() == 0


def graded(count, seed):
    chance = random.Random(seed)
    good, bad = [f"good{i}" for i in range(80)], [f"$$junk{i}" for i in range(80)]
    rows = []
    for i in range(count):
        poor = chance.random() < 0.2
        words = chance.choices(good, k=chance.randint(1, 80)) if not poor else chance.choices(bad, k=chance.randint(5, 80))
        rows.append((i, " ".join(words), poor))
    return rows


@pytest.fixture(scope="module")
def mixed(spark):
    rows = graded(1500, 2)
    docs = edge.docs(spark, [(i, text) for i, text, _ in rows], partitions=6)
    labels = spark.createDataFrame([(i, int(not poor), 0, "t") for i, _, poor in rows if i % 3 == 0], LABELS)
    return docs, labels, {i for i, _, poor in rows if poor}


def plain_grams(raw):
    """Hashed words and word pairs in whole numbers, written without the operator's helpers."""
    full = 2**64 - 1
    hashes = [xxhash.xxh3_64_intdigest(word) for word in raw.lower().split()]
    grams = [number >> 48 for number in hashes]
    for one, two in itertools.pairwise(hashes):
        pair = (one * 0x9E3779B97F4A7C15 & full) ^ (two >> 1)
        grams.append(((pair ^ (pair >> 29)) * 0x9E3779B97F4A7C15 & full) >> 48)
    return grams


def plain_noise(doc_id):
    uniform = (xxhash.xxh3_64_intdigest(str(doc_id).encode(), seed=20240229) + 0.5) / 2.0**64
    return -math.log(-math.log(min(max(uniform, 1e-300), 1 - 2.0**-53)))


def brute_sample(docs, labels, missed):
    """The same draw without Spark and without the operator: counts, weights, noise and a plain sort."""
    rows = [(row.doc_id, plain_grams((row.text or "").encode())) for row in docs.select("doc_id", "text").collect()]
    good = {row.doc_id for row in labels.collect() if row.quality == 1 and not row.toxic}
    raw = Counter(gram for _, grams in rows for gram in grams)
    target = Counter(gram for doc_id, grams in rows if doc_id in good for gram in grams)
    scale = sum(target.values()) / sum(raw.values())
    weighed = []
    for doc_id, grams in rows:
        own, total = Counter(grams), 0.0
        for gram, times in own.items():
            seen = target[gram] - times if doc_id in good else target[gram]
            total += times * math.log((seen + 4.0) / (raw[gram] * scale + 4.0))
        weight = 64 * total / (len(grams) + 64)
        weighed.append((weight, weight + plain_noise(doc_id), doc_id))
    bound = sorted(weight for weight, _, doc_id in weighed if doc_id in good)
    bound = bound[max(0, math.ceil(missed * len(bound)) - 1)]
    k = sum(weight >= bound - 1e-9 for weight, _, _ in weighed)
    least = sorted((key for _, key, _ in weighed), reverse=True)[k - 1]
    return sorted((doc_id, key >= least) for _, key, doc_id in weighed), k


def test_sample_equals_brute_force(mixed):
    docs, labels, _ = mixed
    for missed in (0.001, 0.05):
        wanted, k = brute_sample(docs, labels, missed)
        found = edge.rows(importance.sample(docs, labels, missed), "doc_id", "kept")
        assert found == wanted and sum(kept for _, kept in found) == k


def test_sample_leaves_junk_and_takes_the_good(mixed):
    docs, labels, poor = mixed
    kept = {row.doc_id: row.kept for row in importance.sample(docs, labels).collect()}
    unlabelled = [i for i in kept if i % 3]
    assert sum(kept[i] for i in unlabelled if i in poor) <= 0.02 * len(unlabelled)
    assert sum(not kept[i] for i in unlabelled if i not in poor) <= 0.02 * len(unlabelled)


def test_quality_stage_keeps_columns(mixed):
    docs, labels, _ = mixed
    stay = importance.keep_sampled(docs, labels)
    assert stay.columns == docs.columns
    drawn = {row.doc_id for row in importance.sample(docs, labels).filter("kept").collect()}
    assert {row.doc_id for row in stay.collect()} == drawn


def test_sampling_awkward_documents(spark):
    labels = spark.createDataFrame([(1, 1, 0, "t"), (6, 1, None, "t"), (6, 1, 0, "t"), (None, 1, 0, "t"), (13, 0, 1, "t")], LABELS)
    docs = edge.docs(spark)
    found = edge.rows(importance.sample(docs, labels), "doc_id", "kept")
    assert len(found) == len(edge.TEXTS)
    kept = dict((i, k) for i, k in found if i is not None)
    assert kept[1] and kept[6]
    assert all(row.kept and row.log_weight is None for row in importance.sample(docs, labels.filter("quality = 0")).collect())
    assert importance.keep_sampled(docs, labels.limit(0)).count() == len(edge.TEXTS)
    assert importance.sample(edge.docs(spark, []), labels).count() == 0
    assert importance.keep_sampled(edge.docs(spark, []), labels).count() == 0


def test_kth_largest(spark):
    chance = random.Random(7)
    values = [chance.choice([chance.randint(-(2**63), 2**63 - 1), chance.randint(-5, 5)]) for _ in range(500)]
    table = spark.createDataFrame([(v,) for v in values], "v bigint")
    for k in (1, 2, 100, 250, 499, 500):
        assert importance.kth_largest(table, "v", k) == sorted(values, reverse=True)[k - 1]
    assert [importance._sortable(x) for x in (-9.5, -0.1, 0.0, 0.1, 7.0)] == sorted(importance._sortable(x) for x in (7.0, 0.1, -0.1, -9.5, 0.0))
