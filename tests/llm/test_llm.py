"""The dealt operators against plain Python on small rows that hold the awkward cases."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from math import log10

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from ratebook.llm import chat, components, decontamination, ngram_join, packing, ppm
from ratebook.llm import quality_rules, queries, substring_dedup, suffix_dedup, token_counts
from ratebook.llm import toxicity

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile(rb"[^\x20\x09-\x0D]+")
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
ODD = [
    None,
    "",
    " ",
    "a b c",
    "A b\tC",
    "a  b   c \n \n d",
    "x" * 3000,
    "ab" * 400,
    "word " * 90,
    "é" * 300,
    " <|endoftext|> a<|endoftext|> \n <|endoftext|>",
    "it's  12 days　 日本語",
    "1d10t and i d i o t",
]


@pytest.fixture(scope="module")
def docs(spark):
    """Documents with odd texts, repeated rows, a null id and columns of clashing names."""
    given = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    rows = [(10_000 + i, t) for i, t in enumerate(ODD)] + [(20_000, "again " * 60)] * 2
    rows.append((None, "no id here"))
    odd = spark.createDataFrame(rows, "doc_id long, text string")
    return given.union(odd).withColumn("key", F.lit(1)).withColumn("n", F.lit("x"))


@pytest.fixture(scope="module")
def texts(docs):
    return [(r["doc_id"], r["text"] or "") for r in docs.collect()]


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def found(df, *columns):
    return Counter(tuple(r[c] for c in columns) for r in df.collect())


def windows_seen(sequences, width):
    return Counter(tuple(s[i : i + width]) for s in sequences for i in range(len(s) - width + 1))


def covered(sequence, width, seen):
    gone = [False] * len(sequence)
    for i in range(len(sequence) - width + 1):
        if seen[tuple(sequence[i : i + width])] > 1:
            gone[i : i + width] = [True] * width
    return gone


def test_token_counts(docs, texts, empty):
    tokenizer = Tokenizer.from_file(queries.VOCABULARY)
    expected = Counter()
    for i, t in texts:
        n = len(tokenizer.encode(t, add_special_tokens=False).ids)
        expected[i, len(t.encode()), n, n > 1024] += 1
    got = token_counts.token_counts(docs, queries.VOCABULARY)
    assert found(got, "doc_id", "n_bytes", "n_tokens", "over_limit") == expected
    assert token_counts.token_counts(empty, queries.VOCABULARY).count() == 0


def test_packing(docs, texts, empty):
    tokenizer = Tokenizer.from_file(queries.VOCABULARY)
    rows = packing.pack(docs, queries.VOCABULARY).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append((r["start"], r["length"], r["ids_crc32"], r["piece"]))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    expected = defaultdict(list)
    for i, t in texts:
        ids = np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 0], "<u4")
        starts = [0, *range((len(ids) - 1) % 2048 + 1, len(ids), 2048)]
        for k, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)], strict=True)):
            expected[i].append((a, b - a, zlib.crc32(ids[a:b].tobytes()), k))
    assert {k: sorted(v) for k, v in pieces.items()} == {k: sorted(v) for k, v in expected.items()}
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    assert packing.pack(empty, queries.VOCABULARY).count() == 0


@pytest.mark.parametrize("low,high", [(1, 2049), (300, 700), (900, 1100)])
def test_packing_plan_is_whole_and_close_to_the_bound(low, high):
    lengths = np.random.default_rng(1).integers(low, high, 20_000)
    counts = np.bincount(lengths, minlength=2049)
    classes = packing.plan(counts, 2048)
    got = Counter()
    for content, times in classes:
        assert sum(content) <= 2048
        for n in content:
            got[n] += times
    assert got == Counter(lengths.tolist())
    least = max(-(-lengths.sum() // 2048), (lengths > 1024).sum())
    assert sum(times for _, times in classes) <= 1.2 * least


def test_chat(spark):
    rows = [
        (1, 1, "assistant", "b<|end|>"),
        (1, 0, "user", "a <|image|> <\\|end|>"),
        (2, 0, None, None),
        (2, 0, None, None),
        (None, None, "assistant", "</s>[INST] ok"),
    ]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r["conv_id"]: r for r in chat.digests(chat.format_conversations(turns)).collect()}
    ordered = {1: [rows[1], rows[0]], 2: rows[2:4], None: rows[4:]}
    for key, own in ordered.items():
        spoken = "".join(f"{r or ''}\n{t or ''}\n" for _, _, r, t in own)
        loss = "".join(t or "" for _, _, r, t in own if r == "assistant")
        assert got[key]["n_turns"] == len(own)
        assert got[key]["turns_sha256"] == hashlib.sha256(spoken.encode()).hexdigest()
        assert got[key]["loss_chars"] == len(loss)
        assert got[key]["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
    assert chat.format_conversations(turns.limit(0)).count() == 0


def test_chat_parts(spark):
    kind = "array<struct<type:string,text:string,reference:string,tokens:bigint>>"
    parts = [("text", "see ", None, None), ("image", None, "i.png", 576), ("audio", None, "a", 30)]
    turns = spark.createDataFrame(
        [(1, 0, "user", parts)], f"conv_id long, turn long, role string, parts {kind}"
    )
    row = chat.format_conversations(turns).first()
    assert "see <|image|><|audio|>" in row["formatted"]
    assert [a["reference"] for a in row["attachments"]] == ["i.png", "a"]
    assert row["expanded_tokens"] == 606


def test_quality(spark, docs, texts, empty):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    rows = quality_rules.quality(docs, labels)
    expected = Counter()
    for i, t in texts:
        w = WORD.findall(t.encode())
        seen = windows_seen([w], 3)
        lines = [x for x in t.split("\n") if WORD.search(x.encode())]
        repeat = sum(covered(w, 3, seen))
        chars = sum(len(x.decode()) for x in w)
        signs = sum(t.count(c) for c in "#*$%&|<>")
        failed = len(w) < 50 or 100 * repeat > 50 * len(w)
        expected[i, len(w), chars, signs, len(lines) - len(set(lines)), repeat, failed] += 1
    names = "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed".split()
    assert found(rows, *names) == expected
    assert rows.where("base_failed and kept").count() == 0
    good = rows.join(labels, "doc_id").where("not base_failed")
    assert good.where("kept = (quality = 1)").count() == good.count()
    assert quality_rules.quality(empty, labels).count() == 0
    assert quality_rules.quality(docs, labels.limit(0)).where("kept = base_failed").count() == 0


def test_quality_scores_do_not_depend_on_the_sample(spark, docs):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    whole, few = (quality_rules.quality(docs, labels, sample=n) for n in (20_000, 10))
    assert labels.where("quality = 1").count() > 10
    assert found(few, "doc_id", "score") == found(whole, "doc_id", "score")


def test_quality_threshold_comes_from_all_labelled_rows(spark):
    """Beyond 20,000 ids, over several ranges of scores, with equal scores and repeated ids."""
    rng = np.random.default_rng(3)
    good = rng.random(26_000) < 0.3
    scores = np.round(rng.normal(good * 0.8, 1.0), 3)
    order = np.argsort(scores, kind="stable")
    below = np.cumsum(good[order]) / good.sum() - np.cumsum(~good[order]) / (~good).sum()
    cuts = np.flatnonzero(np.append(np.diff(scores[order]) != 0, True))
    cut = cuts[below[cuts].argmin()]
    wanted = (scores[order][cut] + scores[order][cut + 1]) / 2
    pairs = list(zip(scores.tolist(), good.tolist(), strict=True))
    scored = spark.createDataFrame(pairs, "score double, good boolean")
    assert quality_rules.best_threshold(scored) == wanted
    assert quality_rules.best_threshold(scored.where("good")) == -np.inf
    assert quality_rules.best_threshold(scored.limit(0)) == -np.inf


def test_quality_joins_texts_the_same_way_at_any_size(spark, docs, monkeypatch):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    plans = []
    counted = quality_rules.ngram_counts

    def seen(marked):
        plans.append(marked._jdf.queryExecution().executedPlan().toString())
        return counted(marked)

    monkeypatch.setattr(quality_rules, "ngram_counts", seen)
    quality_rules.quality(docs, labels)
    assert "SortMergeJoin" in plans[0] and "Broadcast" not in plans[0]


def test_substring_dedup(docs, texts, empty):
    words = [(i, WORD.findall(t.encode())) for i, t in texts]
    seen = windows_seen([w for _, w in words], 35)
    expected = Counter()
    for i, w in words:
        gone = covered(w, 35, seen)
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        expected[i, len(w), sum(gone), hashlib.sha256(kept).hexdigest()] += 1
    got = substring_dedup.dedup_windows(docs)
    assert found(got, "doc_id", "n_words", "n_removed", "kept_sha256") == expected
    assert substring_dedup.dedup_windows(empty).count() == 0


@pytest.mark.parametrize("hot", [2, 20_000])
def test_suffix_dedup(docs, texts, empty, hot):
    seen = Counter()
    for _, t in texts:
        raw = t.encode()
        seen.update(raw[i : i + 200] for i in range(len(raw) - 199))
    expected = Counter()
    for i, t in texts:
        raw = t.encode()
        gone = bytearray(len(raw))
        for k in range(len(raw) - 199):
            if seen[raw[k : k + 200]] > 1:
                gone[k : k + 200] = b"\1" * 200
        kept = bytes(x for x, g in zip(raw, gone, strict=True) if not g)
        spans = len(re.findall(b"\1+", bytes(gone)))
        expected[i, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()] += 1
    got = suffix_dedup.dedup_strings(docs, hot=hot)
    assert found(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == expected
    assert suffix_dedup.dedup_strings(empty).count() == 0


def test_log_index_equals_counting():
    rng = np.random.default_rng(3)
    batches = [rng.integers(0, 500, n).astype(np.uint64) for n in (40, 1, 200, 7, 90)]
    index = suffix_dedup.LogIndex()
    for batch in batches:
        index.add(batch)
    every = np.concatenate(batches)
    counts = Counter(every.tolist())
    assert index.repeated().tolist() == [counts[x] > 1 for x in every.tolist()]


def test_decontamination(spark, docs, texts, empty):
    text = "One two, three four five six seven eight nine ten eleven twelve"
    items = spark.createDataFrame(
        [(1, text), (2, "short item"), (2, "short item"), (3, None), (None, "...")],
        "item_id long, text string",
    )
    own = spark.createDataFrame(
        [(1, f"so {text.upper()} end"), (2, "a short item b short item"), (3, text[:40]), (4, None)],
        "doc_id long, text string",
    )
    got = {r["doc_id"]: r for r in decontamination.contamination(own, items).collect()}
    sha = {k: hashlib.sha256(k.encode()).hexdigest() for k in ("", "1", "2")}
    assert [(got[i]["n_words"], got[i]["n_hit"], got[i]["n_items"]) for i in (1, 2, 3, 4)] == [
        (14, 12, 1),
        (6, 4, 1),
        (8, 0, 0),
        (0, 0, 0),
    ]
    assert [got[i]["items_sha256"] for i in (1, 2, 3)] == [sha["1"], sha["2"], sha[""]]
    assert decontamination.contamination(empty, items).count() == 0
    assert decontamination.contamination(docs, items.limit(0)).where("contaminated").count() == 0
    assert decontamination.contamination(docs, items).count() == len(texts)


@pytest.mark.parametrize("frequent", [3, 200])
def test_jaccard_components(docs, texts, empty, frequent, monkeypatch):
    monkeypatch.setattr(ngram_join, "FREQUENT", frequent)
    monkeypatch.setattr(ngram_join, "TIMES_MEAN", 0)
    sets = []
    for i, t in texts:
        w = WORD.findall(t.encode().translate(LOWER))
        five = {tuple(w[k : k + 5]) for k in range(len(w) - 4)}
        sets.append((i, five if len(w) >= 5 else {tuple(w)} if w else set()))
    name = list(range(len(sets)))

    def root(x):
        while name[x] != x:
            x = name[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            common = len(sets[a][1] & sets[b][1])
            if common and 100 * common >= 80 * (len(sets[a][1]) + len(sets[b][1]) - common):
                name[root(a)] = root(b)
    ids = defaultdict(list)
    for k, (i, _) in enumerate(sets):
        ids[root(k)].append(i)
    least = {r: min((i for i in v if i is not None), default=None) for r, v in ids.items()}
    expected = Counter((i, len(s), least[root(k)]) for k, (i, s) in enumerate(sets))
    got = ngram_join.jaccard_components(docs)
    assert found(got, "doc_id", "n_shingles", "component_id") == expected
    assert ngram_join.jaccard_components(empty).count() == 0


def test_bitmaps_never_exceed_the_tokens_apart():
    tokens = np.random.default_rng(3).integers(0, 2**63, 90_000, dtype=np.uint64)
    sizes = [0, 1, 1024, 1025, 4090, 4100, 70_000, 90_000]
    bounds = np.append(0, np.cumsum(sizes))
    made = ngram_join.bitmaps(np.concatenate([tokens[:n] for n in sizes]), bounds)
    pairs = [(i, k) for i in range(len(sizes)) for k in range(len(sizes))]
    apart = ngram_join.bits_apart([made[i] for i, _ in pairs], [made[k] for _, k in pairs])
    assert all(d <= abs(sizes[i] - sizes[k]) for d, (i, k) in zip(apart, pairs, strict=True))
    assert all(d > 0 for d, (i, k) in zip(apart, pairs, strict=True) if abs(i - k) > 1)
    assert len(ngram_join.bits_apart([], [])) == 0


def test_components_of_a_long_path(spark):
    links = spark.range(60).selectExpr("id AS a", "id + 1 AS b").union(spark.range(1).selectExpr("100", "101"))
    got = {r["node"]: r["component"] for r in components.components(links).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}


def test_ppm(docs, texts, empty):
    out = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    held = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in texts]
    words = [[*WORD.findall(t.encode().translate(LOWER)), None] for _, t in texts]
    counts = Counter(w for own, h in zip(words, held, strict=True) if not h for w in own)
    total = sum(counts.values())
    expected = Counter()
    for (i, _), own, h in zip(texts, words, held, strict=True):
        base = sum(log10((counts[w] + 1) / (total + len(counts) + 1)) for w in own)
        expected[i, h, len(own), sum(counts[w] > 0 for w in own), total, round(base, 4)] += 1
    rows = ppm.score(docs, out).collect()
    got = Counter(
        (r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 4))
        for r in rows
    )
    assert got == expected
    assert all(r["score"] < 0 for r in rows)
    assert ppm.score(empty, out).count() == 0


def test_trie_probabilities_sum_to_one():
    data = np.frombuffer(b"the cat and the hat, the end", np.uint8)
    keys, _ = ppm.gram_keys(data, np.array([0, 10, 28]))
    trie = ppm.Trie(*ppm._runs(keys))
    for context in [*keys, np.uint64(0x7A7A7A7A7A00)]:
        every = (context & ~np.uint64(255)) | np.arange(256, dtype=np.uint64)
        assert 0.99 < (10 ** trie.log10(every)).sum() <= 1.0001


def test_ppm_keeps_every_gram(spark):
    """More distinct grams than the cap there once was, most seen once: scores of the whole trie."""
    rng = np.random.default_rng(7)
    texts = ["".join(map(chr, t)) for t in rng.integers(33, 127, (300, 4000))]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    data = np.frombuffer("".join(texts[:270]).encode(), np.uint8)
    keys, counts = ppm._runs(ppm.gram_keys(data, np.arange(271) * 4000)[0])
    assert len(keys) > 1_000_000
    trie = ppm.Trie(keys, counts)
    got = {r["doc_id"]: r["score"] for r in ppm.score(rows, F.col("doc_id") >= 270).collect()}
    assert len(got) == 300
    for i in (0, 150, 270, 299):
        own = np.frombuffer(texts[i].encode(), np.uint8)
        whole = trie.log10(ppm.gram_keys(own, np.array([0, len(own)]))[0]).sum()
        assert abs(got[i] - whole) < 1e-5 * abs(whole)


def test_ppm_without_training_rows(spark):
    rows = spark.createDataFrame([(1, "abc"), (2, None)], "doc_id long, text string")
    got = {r["doc_id"]: r["score"] for r in ppm.score(rows, F.lit(True)).collect()}
    assert abs(got[1] + 4 * log10(257)) < 1e-5 and abs(got[2] + log10(257)) < 1e-5


def test_toxicity(spark, docs, empty):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    rows = toxicity.toxicity(docs, labels, out)
    assert rows.count() == docs.count()
    assert rows.where("score < 0 or score > 1 or (score >= 0.5) != (predicted = 1)").count() == 0
    assert toxicity.toxicity(empty, labels, out).count() == 0
    assert toxicity.toxicity(docs, labels.limit(0), out).count() == docs.count()


def test_toxicity_held_out_accuracy(spark):
    rows = queries.op8_toxicity(spark, "/root/testdata/sf0.1").where("held_out")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    scored = rows.join(labels, "doc_id").select("score", "toxic").toPandas()
    good, bad = (scored.score[scored.toxic == t].to_numpy() for t in (0, 1))
    assert np.mean(bad[:, None] > good[None, :]) + np.mean(bad[:, None] == good[None, :]) / 2 > 0.9


def test_deobfuscation(spark):
    texts = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("text")
    channel = toxicity.Channel(toxicity.count_trigrams(texts))
    for written, meant in {"1d10t": "idiot", "s-c-u-m": "scum", "stuuuupid": "stupid"}.items():
        assert channel.restore(f"such {written} things") == f"such {meant} things"


def test_deobfuscation_at_the_end_of_a_word(spark):
    texts = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("text")
    channel = toxicity.Channel(toxicity.count_trigrams(texts))
    words = {"idio7": "idiot", "1d107": "idiot", "b@stard5": "bastards", "idi0t$": "idiots", "1d10t!": "idiot!"}
    for written, meant in {**words, "m 0 r 0 n": "moron", "hello!": "hello!"}.items():
        assert channel.restore(written) == meant
        got = [d.tobytes() for *_, d, _ in toxicity.restored_slices(pa.array([f"such {written}."]), channel)]
        assert got == [f"such {meant}.".encode()]


def test_prefilter_loses_no_token():
    channel = toxicity.Channel(np.random.default_rng(5).integers(0, 9, 28**3))
    rng = np.random.default_rng(6)
    signs = [*toxicity.READINGS, *"aabbclostAZ"]
    lines = ["m 0 r 0 n", "you l 0 s 3 r.", "1 d 1 0 t", "idio7", "a!$", "x·€·£", "€ £ € b", "s€.£££££$.t"]
    for breaks in ("", " ", "·", "-", ". ", "! ·-"):
        for _ in range(4000):
            word = "".join(
                str(rng.choice(signs)) * int(rng.choice([1, 1, 1, 3]))
                + (str(rng.choice([*breaks])) if breaks and rng.random() < 0.8 else "")
                for _ in range(rng.integers(1, 9))
            )
            lines.append(str(rng.choice(["", "such “", "é "])) + word + str(rng.choice(["", ".", "!", "’ s"])))
    for own in (lines, ["\n".join(lines)]):
        column = pa.array(own)
        got = b"".join(d.tobytes() for *_, d, _ in toxicity.restored_slices(column, channel))
        plain = "".join("\n".join(channel.restore(x) for x in t.split("\n")) for t in own)
        assert got == plain.encode().translate(LOWER)


def test_one_row_of_each_group_stays(spark):
    words = [f"w{i}" for i in range(40)]
    near, other = " ".join(words), " ".join([*words[:-1], "end"])
    rows = [(None, near), (None, other), (5, " ".join(f"x{i}" for i in range(40)))]
    rows += [(7, near.upper().replace("W", "v")), (7, other.upper().replace("W", "v"))]
    rows += [(8, " "), (8, " "), (None, None), (None, None)]
    given = spark.createDataFrame(rows, "doc_id long, text string")
    stay = corpus_pipeline.one_of_each_group(spark, given, FOLDER).collect()
    assert Counter(r["doc_id"] for r in stay) == {None: 3, 5: 1, 7: 1, 8: 2}
    assert sum(r["text"] in (near, other) for r in stay) == 1


def test_pipeline(spark):
    before = spark.read.parquet(f"{FOLDER}/documents.parquet")
    packed = corpus_pipeline.run(spark, FOLDER)
    assert [name for name, _ in corpus_pipeline.STAGES][-1] == "best_fit_packing"
    assert packed.select("doc_id").distinct().count() < before.count()
    assert packed.join(before, "doc_id", "left_anti").count() == 0


def test_decontamination_equals_brute_force(spark):
    rng = np.random.default_rng(5)
    vocabulary = ["a", "B", "É", "é", "ÉTÉ", "été", "K", "k", "İx", "ΑΣ", "日本", "Zz9"]
    marks = [" ", ", ", "'", "\n", "-"]

    def text(n):
        return "".join(str(rng.choice(vocabulary)) + str(rng.choice(marks)) for _ in range(n))

    passages = [text(n) for n in (30, 12, 10)]
    own = [(i, text(int(n))) for i, n in enumerate(rng.integers(0, 60, 40))]
    own += [
        (i + 100, t + p.upper().replace("İX", "İx") + t)
        for i, (_, t) in enumerate(own)
        for p in passages[i % 4 :][:1]
    ]
    own += [(500, "a " * 200), (501, "...no word of it"), (502, passages[0] * 3), (None, passages[1])]
    items = [(i, p) for i, p in enumerate(passages)]
    items += [(10 + n, text(n)) for n in (2, 3, 4, 7, 9, 11)] + [(20, "a " * 10), (21, "été k"), (22, "")]

    def words(t):
        return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.encode().translate(LOWER))

    holders = defaultdict(set)
    for i, t in items:
        w = words(t)
        width = min(10, len(w))
        for k in range(len(w) - width + 1 if w else 0):
            holders[tuple(w[k : k + width])].add(str(i))
    expected = Counter()
    for i, t in own:
        w, hit, ids = words(t), set(), set()
        for width in {len(x) for x in holders}:
            for k in range(len(w) - width + 1):
                if found_in := holders.get(tuple(w[k : k + width])):
                    hit.update(range(k, k + width))
                    ids |= found_in
        sha = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        expected[i, len(w), len(hit), len(ids), sha, bool(hit)] += 1
    assert sum(n for (*_, hit), n in expected.items() if hit) > 30
    got = decontamination.contamination(
        spark.createDataFrame(own, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string"),
    )
    names = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert found(got, *names) == expected


def test_fingerprints_in_compiled_code(spark, capsys):
    """Texts are cut once, and no array is sliced; methods are small enough for the JVM to compile."""
    own = spark.createDataFrame([(1, "A b c " * 9), (2, None)], "key long, text string")
    rows = own.select("key", decontamination.words_of(own["text"]).alias("words"))
    made = decontamination._fingerprints(rows, 10, 5, [2, 7])
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert plan.count("split(") == 1
    assert "slice(" not in plan
    made.explain("codegen")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert sizes and max(sizes) < 8000
