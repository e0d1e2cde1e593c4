"""Resampling, SimHash and collocations against plain Python and SQL."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from compare import database, differences
from pyspark.sql import functions as F
from test_llm import FOLDER, LOWER, ODD, WORD, docs, empty, found, texts  # noqa: F401

from ratebook.llm import collocations, importance, queries, simhash

ALNUM = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


@pytest.mark.parametrize("name", ["op11_importance_resampling", "op13_collocations"])
def test_query_equals_sql(spark, name):
    more, less, count = differences(
        spark, database(FOLDER), queries.QUERIES[name], queries.ORACLE[name], FOLDER
    )
    assert not more and not less
    assert count > 0


# --- importance resampling ---------------------------------------------------


def _features(text):
    w = ALNUM.findall(text.encode().translate(LOWER))
    return w, [b" ".join(w[i : i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1)]


def _resampled(rows, target):
    def totals(every):
        return Counter(zlib.crc32(f) % 10000 for t in every for f in _features(t)[1])

    raw, aim = totals(t for _, t in rows), totals(target)
    size, wanted = float(sum(raw.values()) + 10000), float(sum(aim.values()) + 10000)
    gain = [
        math.floor(1000 * math.log((aim[b] + 1.0) * size / ((raw[b] + 1.0) * wanted)))
        for b in range(10000)
    ]
    scored = []
    for i, t in rows:
        words, features = _features(t)
        weight = sum(gain[zlib.crc32(f) % 10000] for f in features)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        scored.append((i, len(words), len(features), weight, score))
    able = sorted(
        (s for s in scored if s[1] >= 20),
        key=lambda s: (-s[4], s[0] is None, s[0] or 0, s[1], s[2], s[3]),
    )
    drawn = [(*s[:1], *s[2:], k + 1) for k, s in enumerate(able[: 5 * len(able) // 100])]
    return Counter((*s[:1], *s[2:]) for s in scored), Counter(drawn)


@pytest.fixture(scope="module")
def target(spark):
    return spark.read.parquet(f"{FOLDER}/benchmark.parquet").withColumn("bucket", F.lit(1))


def _check_resampled(docs, rows, target, wanted):  # noqa: F811
    got = importance.resample(docs, target)
    every, drawn = _resampled(rows, wanted)
    columns = ("doc_id", "n_features", "weight", "score")
    assert found(got, *columns) == every
    assert found(got.where("rank IS NOT NULL"), *columns, "rank") == drawn
    assert sum(drawn.values()) > 0


def test_resampling(spark, docs, texts, empty, target):  # noqa: F811
    wanted = [r["text"] or "" for r in target.collect()]
    _check_resampled(docs, texts, target, wanted)
    assert importance.resample(empty, target).count() == 0
    assert importance.resample(docs, target.limit(0)).count() == len(texts)


def test_the_head_does_not_change_the_result(spark, docs, texts, target, monkeypatch):  # noqa: F811
    wanted = [r["text"] or "" for r in target.collect()]
    monkeypatch.setattr(importance, "HEAD_WORDS", 5)
    _check_resampled(docs, texts, target, wanted)


def test_resampling_of_copies_and_long_texts(spark, target):
    """A third of the rows are one row; one text has over a million bytes, one a very long word."""
    rows = [(7, "one and the same row " * 6)] * 300
    rows += [(i, f"row {i} of all " * (i % 9)) for i in range(600)]
    rows += [(1000, "many words in a long text " * 50_000), (1001, "x" * 100_000 + " y")]
    given = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    _check_resampled(given, rows, target, [r["text"] for r in target.collect()])


def test_crc_states_combine():
    rng = np.random.default_rng(5)
    left = [rng.bytes(int(n)) for n in rng.integers(0, 200, 200)]
    right = [rng.bytes(int(n)) for n in rng.integers(0, importance.WORD_BYTES + 2, 200)]
    states = [np.array([zlib.crc32(t) for t in side], np.uint32) for side in (left, right)]
    made = importance.combine(*states, np.array([len(t) for t in right]))
    assert made.tolist() == [zlib.crc32(a + b) for a, b in zip(left, right, strict=True)]


# --- SimHash -------------------------------------------------------------------


def _fingerprint(text):
    w = WORD.findall(text.encode().translate(LOWER))
    shingles = [b" ".join(w[i : i + 4]) for i in range(len(w) - 3)] or ([b" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _components(prints):
    parent = list(range(len(prints)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    values = np.array(prints, np.uint64)
    near = np.bitwise_count(values[:, None] ^ values[None, :]) <= 4
    for a, b in zip(*np.nonzero(np.triu(near, 1)), strict=True):
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(prints))]


def _near(rows):
    prints = [_fingerprint(t) for _, t in rows]
    least, roots = {}, _components(prints)
    for (i, _), r in zip(rows, roots, strict=True):
        least[r] = i if least.get(r) is None else least[r] if i is None else min(i, least[r])
    return Counter((i, f"{p:016x}", least[r]) for (i, _), p, r in zip(rows, prints, roots, strict=True))


def test_near_duplicates(spark, docs, texts, empty, monkeypatch):  # noqa: F811
    words = ("the quick brown fox jumps over the lazy dog and runs " * 12).split()
    rows = []
    for i in range(150):
        changed = list(words)
        for k in range(i % 4):
            changed[(7 * i + 31 * k) % len(words)] = f"w{i}"
        rows.append((50_000 + i, " ".join(changed)))
    more = spark.createDataFrame(rows, "doc_id long, text string")
    given = docs.select("doc_id", "text", F.lit(1).alias("fingerprint")).union(
        more.withColumn("fingerprint", F.lit(2))
    )
    expected = _near(texts + rows)
    columns = ("doc_id", "fingerprint", "component_id")
    assert found(simhash.near_duplicates(given), *columns) == expected
    assert len({r for _, _, r in expected}) < len(expected) - 40
    # groups that are cut bit by bit, and more of them
    monkeypatch.setattr(simhash, "GROUP_VARIANTS", 20_000)
    monkeypatch.setattr(simhash, "AT_ONCE", 3_000)
    assert found(simhash.near_duplicates(given), *columns) == expected
    assert simhash.near_duplicates(empty).count() == 0


def test_fingerprints_of_long_texts_and_copies(spark):
    rows = [(None, "a copy of a short text")] * 200 + [(3, "long " * 250_000), (4, "z" * 100_000)]
    got = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert found(got, "doc_id", "fingerprint", "component_id") == _near(rows)


def test_one_shingle_is_its_own_hash(spark):
    df = spark.createDataFrame([(1, "Some four words here")], "doc_id long, text string")
    got = simhash.fingerprints(df).first().fingerprint
    assert got == df.select(F.xxhash64(F.lower("text"))).first()[0]


@pytest.mark.parametrize("lead,at_once", [(1, 20_000), (4, 1 << 21), (9, 1 << 21)])
def test_links_connect_what_all_pairs_connect(lead, at_once, monkeypatch):
    """Random fingerprints, near ones, and a crowd of chained ones."""
    monkeypatch.setattr(simhash, "AT_ONCE", at_once)
    rng = np.random.default_rng(3)
    made = rng.integers(0, 2**64, 150, dtype=np.uint64).tolist()

    def flipped(value, bits):
        for i in rng.choice(64, bits, replace=False).tolist():
            value ^= 1 << i
        return value

    made += [flipped(made[i], int(rng.integers(1, 7))) for i in range(100) for _ in range(2)]
    crowd = [made[0]]
    for _ in range(200):
        crowd.append(flipped(crowd[int(rng.integers(len(crowd)))], 3))
    prints = np.unique(np.array(made + crowd, np.uint64))
    near = np.concatenate(simhash.flips(lead))
    groups = (prints >> np.uint64(64 - lead))[:, None] ^ near[None, :]
    number = {int(p): i for i, p in enumerate(prints)}
    labels, sent = np.arange(len(prints)), 0
    for group in np.unique(groups):
        members = prints[(groups == group).any(1)]
        a, b = simhash.group_links(members, int(group), lead)
        assert len(a) < len(members)
        sent += len(a)
        places = ([number[int(x)] for x in side] for side in (a, b))
        labels = simhash._connect(labels, *(np.array(p, np.int64) for p in places))
    assert labels.tolist() == _components(prints.tolist())
    assert sent > 0


# --- collocations -----------------------------------------------------------------


def _mined(rows, least, top):
    n, f = Counter(), defaultdict(Counter)
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(rb"[.,;:!?\x0A-\x0D]", (text or "").encode().translate(LOWER)):
            w = re.findall(rb"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in (1, 2, 3):
                f[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = Counter()
    for lang, counts in f.items():
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        ranked = []
        for p, a in candidates.items():
            longer = [
                b for q, b in candidates.items()
                if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
            ]
            if longer and 100 * max(longer) >= 50 * a:
                continue
            cuts = [
                (1_000_000 * a * a // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p))
            ]
            score, k = min(cuts)
            ranked.append((-score, -a, b" ".join(p), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(ranked)[:top]):
            out[lang, rank + 1, phrase.decode(), -a, left, right, n[lang], -score] += 1
    return out


COLUMNS = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


@pytest.mark.parametrize("least,top", [(2, 40), (3, 1000)])
def test_collocations(spark, least, top):
    given = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text", "lang")
    given = given.where("doc_id % 4 = 0")  # the plain version is quadratic
    langs = ("en", None, "und", "x")
    rows = [(900 + i, t, langs[i % 4]) for i, t in enumerate(ODD)]
    rows += [(None, "New York is new york, New  York\tis. big NEW YORK! is", None)] * 3
    rows += [(1, "in in in in\nin in\x0bin", "en"), (2, "de la  de la;de la de", "und")]
    extra = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    both = given.union(extra).withColumn("place", F.lit("x")).withColumn("phrase", F.lit(1))
    expected = _mined([(r.lang, r.text) for r in both.collect()], least, top)
    got = collocations.collocations(both, least=least, top=top)
    assert found(got, *COLUMNS) == expected
    assert {k[0] for k in expected} >= {"en", "und"}
    assert collocations.collocations(both.limit(0)).count() == 0


def test_collocations_in_small_places_and_of_long_texts(spark, monkeypatch):
    monkeypatch.setattr(collocations, "PLACE_BYTES", 20_000)
    rows = [(i, f"alpha beta gamma {i % 7} delta, alpha beta", "en") for i in range(400)]
    rows += [(9, "very long text without an end " * 40_000, "long"), (10, "w" * 100_000, "en")]
    given = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    expected = _mined([(lang, t) for _, t, lang in rows], 10, 2000)
    assert found(collocations.collocations(given), *COLUMNS) == expected


def test_scores_past_64_bits(spark):
    big = 4_000_000_000
    rows = [("en", 1, "a", big + 3), ("en", 1, "b", big + 1), ("en", 2, "a b", big)]
    counts = spark.createDataFrame(rows, "lang string, size int, phrase string, a long")
    found_score = collocations.scored(counts).first()
    assert found_score.score == 1_000_000 * big * big // ((big + 3) * (big + 1))


def test_phrases_of_one_hash_are_counted_by_their_words():
    """One text is built for each different phrase, also where phrases share a hash."""
    given = pa.chunked_array([pa.array(["a b a b é b\ta b. a  b, A b c c c c"]), pa.array(["a b", ""])])
    slices = [collocations._Phrases(d, o) for _, _, d, o in collocations.text_slices(given)]
    bases = np.cumsum([0] + [len(p.starts) for p in slices])
    spelled = collocations._Spelled(slices)
    pieces = ["a b a b é b a b", "a b", "a b c c c c", "a b"]
    for size in (1, 2, 3):
        hashed = [(at + base, h) for base, p in zip(bases, slices) for at, h in (p.hashed(size),)]
        at, hashes = (np.concatenate(c) for c in zip(*hashed))
        words = [piece.split(" ") for piece in pieces]
        expected = Counter(
            " ".join(w[i : i + size]) for w in words for i in range(len(w) - size + 1)
        )
        for few in (64, 1, 0):  # bits of the hashes that are left
            short = hashes >> np.uint64(64 - few) if few else np.zeros(len(hashes), np.uint64)
            order = np.argsort(short, kind="stable")
            firsts, own, times = spelled.distinct(at[order], short[order], size)
            texts = spelled.texts(firsts, size).to_pylist()
            assert len(set(texts)) == len(texts) == len(own)
            assert dict(zip(texts, map(int, times))) == expected


def test_one_blob_for_all_languages_of_a_place_and_a_range(spark, monkeypatch):
    """Places and ranges exchange one row each, and only phrases that are frequent in all come back."""
    rows = [(p, lang, f"{word} x{p}") for p in range(3) for lang, word in (("en", "ab"), ("fr", "cd"))]
    texts = spark.createDataFrame(rows, "place int, lang string, text string")
    supports = spark.createDataFrame(
        [(lang, s, 1) for lang in ("en", "fr") for s in range(3)], "lang string, shard int, support long"
    )
    found = collocations.mined(texts, supports, 1, 2, 3).collect()
    assert sorted(r.place for r in found) == [0, 1, 2]
    for row in found:
        assert sorted(row.langs) == ["en", "fr"]
        # of ab, x0, ab x0 only the first occurs three times
        assert [len(hashes) for hashes, in collocations._unpacked(row.found)] == [1, 1]
    mined = collocations.mined(texts, supports, 1, 2, 3)
    counts = collocations.phrase_counts(texts, mined, 1, 2, 3).collect()
    assert sorted(map(tuple, counts)) == [("en", 1, "ab", 3), ("fr", 1, "cd", 3)]
