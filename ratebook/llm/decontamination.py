"""Benchmark decontamination by winnowing, with DataFrame functions only.

The fingerprint of a window of words is the least hash of the word k-grams in it, so documents and
benchmark items that share a window share a fingerprint, while neighbouring windows mostly have
the same one: two in seven of the k-grams are kept. Documents with a fingerprint of an item are
then compared with the items' windows word by word, and hits extend to all words of every window.
"""

from functools import reduce
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.storage import stored
from .rows import row_key

WINDOW = 10
GRAM = 5
# What separates words, whatever the case of A-Z.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _as_written(text: Column) -> Column:
    """The words of a text before A-Z are lower-cased, none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SEPARATORS), "")


def _lowered(word: Column) -> Column:
    """A-Z lower-cased, and no other letter: `lower` is the faster way for ASCII."""
    ascii_only = F.octet_length(word) == F.length(word)
    return F.when(ascii_only, F.lower(word)).otherwise(
        F.translate(word, ascii_uppercase, ascii_lowercase)
    )


def words_of(text: Column) -> Column:
    """The words of a text, none for null."""
    return F.transform(_as_written(text), _lowered)


def _starts(words: Column, width: int) -> Column:
    """1-based starts of the windows of `width` words."""
    n = F.size(words)
    return F.when(n >= width, F.sequence(F.lit(1), n - width + 1)).otherwise(
        F.array().cast("array<int>")
    )


def _texts(words: Column, width: int) -> Column:
    return F.transform(
        _starts(words, width),
        lambda i: F.struct(
            i.alias("start"),
            F.lit(width).alias("width"),
            F.array_join(F.slice(words, i, width), " ").alias("window"),
        ),
    )


def _hashes(words: Column) -> Column:
    return F.transform(words, lambda word: F.xxhash64(word))


def _fingerprints(df: DataFrame, window: int, gram: int, short: list[int]) -> DataFrame:
    """key and fingerprint; also the hashes of windows of the `short` widths, marked by width.

    Words are hashed once; the rest is compiled code for each start, in steps, since one
    expression would repeat its parts and outgrow what the JVM compiles. A gram's hash is made of
    its words' hashes. A full window whose least gram is that of the window before is left out.
    """
    hashed = df.select("key", _hashes(F.col("words")).alias("hashes"))
    starts = hashed.select(
        "key", "hashes", F.explode(_starts(F.col("hashes"), min([*short, window]))).alias("start")
    )
    # Word 0 is the one before the window, and gram 0 begins there.
    word = [F.get("hashes", F.col("start") - 2 + k).alias(f"word{k}") for k in range(window + 1)]
    words = starts.select("key", "start", F.size("hashes").alias("n"), *word)
    made = [
        reduce(
            Column.bitwiseXOR, [F.shiftleft(f"word{first + k}", k) for k in range(gram)]
        ).alias(f"gram{first}")
        for first in range(window - gram + 2)
    ]
    whole = [
        F.when(
            F.col("start") <= F.col("n") - width + 1,
            F.xxhash64(F.lit(width), F.array(*[f"word{k + 1}" for k in range(width)])),
        ).alias(f"whole{width}")
        for width in short
    ]
    grams = words.select("key", "start", "n", *made, *whole)
    names = [f"gram{k}" for k in range(window - gram + 2)]
    least = grams.select(
        "*", _least(names[:-1]).alias("before"), _least(names[1:]).alias("least")
    )
    new = (F.col("start") == 1) | (F.col("before") != F.col("least"))
    full = F.when((F.col("start") <= F.col("n") - window + 1) & new, F.col("least"))
    # Behind a generator no filter on the result computes it a second time.
    found = F.explode(F.array(full, *[f"whole{width}" for width in short]))
    return least.select("key", found.alias("fingerprint")).where("fingerprint is not null")


def _least(names: list[str]) -> Column:
    return F.least(*names) if len(names) > 1 else F.col(names[0])


def _windows(df: DataFrame, widths: list[int]) -> DataFrame:
    """key, start, width and text of every window of the widths."""
    every = F.concat(*[_texts(F.col("words"), width) for width in widths])
    return df.select("key", F.inline(every))


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    gram: int = GRAM,
    id_column: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, and key, of every row.

    An item of fewer than `window` words, but not none, is one window. Null and empty texts have
    no words and no hits. Repeated rows get the same result each, items of one id count once, a
    null item_id counts as the empty string, a null doc_id stays; other columns are left out;
    either table may be empty. `key` stands for doc_id and text, so the result joins back to
    `docs` by `row_key`. Benchmark tables are stored, so that Spark broadcasts them only while
    their known size is under its own limit, and else joins by shuffle.
    """
    rows = docs.select(
        row_key(id_column, text).alias("key"),
        docs[id_column].alias("doc_id"),
        docs[text].alias("text"),
    )
    words = words_of(F.col("text")).alias("words")
    items = stored(
        benchmark.select(
            F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("key"),
            words,
        ).where(F.size("words") > 0),
        "items",
    )
    sizes = items.where(F.size("words") < window).select(F.size("words").alias("n")).distinct()
    short = sorted(row["n"] for row in sizes.collect())  # below `window`, so few
    known = stored(
        _fingerprints(items.where(F.size("words") >= window), window, gram, [])
        .unionByName(
            items.where(F.size("words") < window).select(
                "key", F.xxhash64(F.size("words"), _hashes(F.col("words"))).alias("fingerprint")
            )
        )
        .select("fingerprint")
        .distinct(),
        "fingerprints",
    )
    widths = [*short, window]
    full = _windows(items.where(F.size("words") >= window), [window])
    whole = items.where(F.size("words") < window).select(
        "key",
        F.lit(1).alias("start"),
        F.size("words").alias("width"),
        F.array_join("words", " ").alias("window"),
    )
    item_windows = stored(
        full.unionByName(whole).select(F.col("key").alias("item"), "width", "window").distinct(),
        "windows",
    )
    suspects = stored(
        _fingerprints(rows.select("key", words), window, gram, short)
        .join(known, "fingerprint", "left_semi")
        .select("key")
        .distinct(),
        "suspects",
    )
    hits = (
        _windows(rows.join(suspects, "key", "left_semi").select("key", words), widths)
        .join(item_windows.select("width", "window").distinct(), ["width", "window"], "left_semi")
        .distinct()
    )
    hits = stored(hits, "hits")
    covered = F.array_distinct(
        F.flatten(
            F.collect_list(F.sequence(F.col("start"), F.col("start") + F.col("width") - 1))
        )
    )
    per_row = hits.groupBy("key").agg(F.size(covered).cast("bigint").alias("n_hit"))
    found = hits.select("key", "width", "window").distinct().join(item_windows, ["width", "window"])
    ids = F.array_sort(F.collect_set("item"))
    per_item = found.groupBy("key").agg(
        F.size(ids).cast("bigint").alias("n_items"), F.concat_ws(",", ids).alias("_items")
    )
    n_words = F.size(_as_written(F.col("text"))).cast("bigint").alias("n_words")
    result = rows.select("key", "doc_id", n_words)
    return (
        result.join(per_row.join(per_item, "key"), "key", "left")
        .select(
            "doc_id",
            "n_words",
            F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
            F.coalesce("n_items", F.lit(0)).cast("bigint").alias("n_items"),
            F.sha2(F.coalesce("_items", F.lit("")), 256).alias("items_sha256"),
            (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
            "key",
        )
    )
