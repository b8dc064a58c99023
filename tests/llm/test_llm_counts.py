"""The divergence audit and phrase mining against brute force on small, awkward documents."""

import random
import re
from collections import Counter, defaultdict

import edge
import numpy as np
import pytest

from cartwright.llm import collocations, divergence_audit, perfect_hash

UPPER = {ord(a): a.lower() for a in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
SCHEMA = "doc_id bigint, text string, lang string, source string, term string, slot int, `count` double, w1 string, bucket int, rank string"


def table(spark, rows, partitions=3):
    return spark.createDataFrame([(i, t, l, s, "t", 1, 0.5, "w", 2, "r") for i, t, l, s in rows], SCHEMA).repartition(partitions)


def mixed(seed, documents, vocabulary=30, langs=("en", "de", None, ""), sources=("a", "b", "c", None), length=40):
    """Documents of random words, a third of them of one source, with odd signs, empty and null texts and repeated rows."""
    chance = random.Random(seed)
    words = [f"W{chr(97 + i % 26)}{'é' * (i % 3)}{chr(97 + i // 26)}" for i in range(vocabulary)] + ["of", "the", "日本", "x1y", " nb", "a\tb"]
    rows = []
    for i in range(documents):
        source = "a" if i % 3 == 0 else chance.choice(sources)
        text = "".join(chance.choice(words) + chance.choice([" ", " ", "  ", ". ", "\n", ",", "\t"]) for _ in range(chance.randint(0, length)))
        rows.append((i, chance.choice([text, text, text, text, "", None]) if i % 7 == 0 else text, chance.choice(langs), source))
    return rows + rows[:5] + [(None, "only Here", "xx", "q"), (None, None, "xx", "p"), (7, "lone", "yy", "z")]


# ---- perfect hashes ------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("size", [1, 2, 3, 7, 100, 5000, 40_000])
def test_perfect_hash_is_minimal_and_perfect(size):
    keys = [f"key{i}".encode() for i in range(size)]
    salt, displacements, slots = perfect_hash.build(keys)
    assert sorted(slots.tolist()) == list(range(size))
    again = perfect_hash.look_up(perfect_hash.hashes(keys[::-1], salt), displacements, size)
    assert again.tolist() == slots[::-1].tolist()
    strange = perfect_hash.look_up(perfect_hash.hashes([b"none", b""], salt), displacements, size)
    assert ((strange >= 0) & (strange < size)).all()


# ---- divergence ----------------------------------------------------------------------------------------------------


def brute_audit(rows, least=3, top=200):
    rows = [(t or "", lang or "", s or "") for _, t, lang, s in rows]
    terms = [re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", t.translate(UPPER)) for t, _, _ in rows]
    docs, counts = Counter(), Counter()
    for (_, lang, _), found in zip(rows, terms):
        docs.update((lang, term) for term in set(found))
    kept = defaultdict(list)
    for (lang, term), n in docs.items():
        if n >= least:
            kept[lang].append(term)
    for (_, lang, source), found in zip(rows, terms):
        counts.update((lang, source, term) for term in found)
    groups = sorted({(lang, s) for _, lang, s in rows})
    share, whole, out = {}, {}, []
    for lang in kept:
        mine = [s for g, s in groups if g == lang]
        sums = {t: sum(counts[lang, s, t] for s in mine) for t in kept[lang]}
        total, v = sum(sums.values()), len(kept[lang])
        whole.update({(lang, t): 1 + 10**9 * (n + 1) // (total + v) for t, n in sums.items()})
        for s in mine:
            n = sum(counts[lang, s, t] for t in kept[lang])
            share.update({(lang, s, t): 1 + 10**9 * (counts[lang, s, t] + 1) // (n + v) for t in kept[lang]})
    for lang, s in groups:
        pairs, found = [], []
        for other in (o for g, o in groups if g == lang and o != s):
            gaps = [(share[lang, s, t], share[lang, other, t]) for t in kept[lang]]
            pairs.append((-sum((p - q) ** 2 // q for p, q in gaps), other.encode()))
        for t in kept[lang]:
            p, q = share[lang, s, t], whole[lang, t]
            if counts[lang, s, t] and p > q:
                found.append((-((p - q) ** 2 // q), t.encode()))
        for part, listed in (("pair", sorted(pairs)), ("term", sorted(found)[:top])):
            out += [(lang, s, part, item.decode(), -value, rank) for rank, (value, item) in enumerate(listed, 1)]
    return sorted(out)


AUDITED = ("lang", "source", "part", "item", "value", "rank")


def test_audit_equals_brute_force(spark):
    rows = mixed(1, 150)
    assert edge.rows(divergence_audit.audit(table(spark, rows)), *AUDITED) == brute_audit(rows)
    assert divergence_audit.audit(table(spark, [])).count() == 0
    alone = [(1, "a b c", "en", "s")]
    assert divergence_audit.audit(table(spark, alone)).count() == 0


def test_audit_in_small_shards_waves_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(divergence_audit, "SHARD_BYTES", 200)
    monkeypatch.setattr(divergence_audit, "WAVE_BYTES", 300)
    monkeypatch.setattr(divergence_audit, "DENSE_SLOTS", 40)
    monkeypatch.setattr(divergence_audit, "BLOCK", 2)
    monkeypatch.setattr(divergence_audit, "CHUNK", 3)
    monkeypatch.setattr(divergence_audit, "MERGED", 2)
    rows = mixed(2, 120, sources=tuple("abcde"), langs=("en", "de"))
    assert edge.rows(divergence_audit.audit(table(spark, rows), top_terms=5), *AUDITED) == brute_audit(rows, top=5)


def test_waves_hold_their_bound(spark):
    kept = spark.createDataFrame([("en", f"term{i}") for i in range(400)], "lang string, term string")
    size = divergence_audit.SHARD_BYTES
    try:
        divergence_audit.SHARD_BYTES = 500
        shards = divergence_audit.build_shards(kept).cache()
        placed, count = divergence_audit.waves(shards, 1500)
        per_wave = placed.selectExpr("wave", "octet_length(terms) + octet_length(displacements) AS b").groupBy("wave").agg({"b": "sum", "*": "count"})
        assert count > 1 and all(row["sum(b)"] <= 1500 or row["count(1)"] == 1 for row in per_wave.collect())
        assert {term for row in shards.collect() for term in row.terms.split(b"\n")} == {f"term{i}".encode() for i in range(400)}
    finally:
        divergence_audit.SHARD_BYTES = size


def test_shares_of_very_large_counts_are_exact():
    counts = [0, 5, 10**10, 3 * 10**12]
    wanted = [1 + 10**9 * (n + 1) // (4 * 10**12 + 7) for n in counts]
    assert divergence_audit.shares(np.array(counts), 4 * 10**12, 7).tolist() == wanted


# ---- phrases -------------------------------------------------------------------------------------------------------


def brute_phrases(rows, least=10, first=2000):
    counts, sizes = defaultdict(Counter), Counter()
    for _, text, lang, _ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\n-\r]", (text or "").translate(UPPER)):
            words = re.findall(r"[^ \t]+", piece)
            sizes[lang] += len(words)
            for k in (1, 2, 3):
                counts[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        listed = []
        for phrase, a in f.items():
            if len(phrase) < 2 or a < least:
                continue
            longer = [p for p in f if len(p) > len(phrase) and f[p] >= least and phrase in (p[:2], p[1:])]
            if len(phrase) == 2 and any(100 * f[p] >= 50 * a for p in longer):
                continue
            score, k = min((10**6 * a * a // (f[phrase[:k]] * f[phrase[k:]]), k) for k in range(1, len(phrase)))
            listed.append((-score, -a, " ".join(phrase).encode(), f[phrase[:k]], f[phrase[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(listed)[:first], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, sizes[lang], -score))
    return sorted(out)


FOUND = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def test_phrases_equal_brute_force(spark):
    rows = mixed(3, 200, vocabulary=12) + [(i, "New York City, new york", "en", "s") for i in range(30)]
    assert edge.rows(collocations.collocations(table(spark, rows)), *FOUND) == brute_phrases(rows)
    assert edge.rows(collocations.collocations(table(spark, rows), first=7), *FOUND) == brute_phrases(rows, first=7)
    assert collocations.collocations(table(spark, [])).count() == 0


def test_phrases_with_split_pairs_and_buckets_in_parts(spark):
    chance = random.Random(4)
    rows = mixed(5, 60, vocabulary=8) + [(i, " ".join(f"hot pair w{chance.randint(0, 40)}" for _ in range(40)), "en", "s") for i in range(60)]
    plain = table(spark, rows).select("text", "lang").fillna("und", ["lang"]).fillna("")
    total, words, pairs = collocations.heavy_prefixes(collocations.prefix_summaries(plain), 64)
    assert total == sum(len(re.findall(r"[^ \t.,;:!?\n-\r]+", t or "")) for _, t, _, _ in rows) and len(words) and len(pairs)
    for bucket, held in ((64, 1 << 22), (1 << 20, 50), (64, 30)):
        found = collocations.collocations(table(spark, rows, 6), bucket=bucket, held=held)
        assert edge.rows(found, *FOUND) == brute_phrases(rows)


@pytest.mark.parametrize("seed", range(3))
def test_quicksort_counts_every_prefix(seed):
    chance = np.random.default_rng(seed)
    codes = chance.integers(0, 6, (3, 800))
    codes[1, :100], codes[2, :150] = -1, -1
    counts = chance.integers(1, 4, 800)
    wanted = Counter()
    for column, count in zip(codes.T.tolist(), counts.tolist()):
        for k in (1, 2, 3):
            if min(column[:k]) >= 0:
                wanted[tuple(column[:k])] += count
    for least in (1, 9, 60):
        found = {tuple(codes[:length, at].tolist()): size for at, length, size in collocations.equal_partitions(codes, counts, [least] * 3).tolist()}
        assert found == {prefix: size for prefix, size in wanted.items() if size >= least}


def test_misra_gries_bound():
    chance = random.Random(1)
    rows = [int(chance.paretovariate(0.8)) for _ in range(6000)]
    keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for start in range(0, len(rows), 200):
        own = Counter(rows[start : start + 200])
        keys, counts = np.concatenate([keys, list(own)]), np.concatenate([counts, list(own.values())])
        keys, counts = collocations._reduced(keys, counts, 30)
    kept = dict(zip(keys.tolist(), counts.tolist()))
    assert len(kept) <= 30 and all(n - len(rows) / 31 <= kept.get(key, 0) <= n for key, n in Counter(rows).items())
