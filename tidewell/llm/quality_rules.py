"""Quality rules by distribution divergence, in DataFrame operations only.

A document's histogram of character classes and its histogram of common words are compared with those of each
reference language by Jensen-Shannon distance (base 2, 0 to 1). The references are the mean histograms of the
corpus' own documents of each language. A document that is far from every language is dropped; short ones, whose
histograms say little, are spared by minimum lengths.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Frequent function words of the reference languages.
COMMON_WORDS = {
    "en": "the of and to in a is that it for was on with as be by at this are from".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als".split(),
    "fr": "de la le et les des en un du une que est pour qui dans a par sur au pas".split(),
    "es": "de la que el en y a los se del las un por con no una su al es lo".split(),
}
# Character classes as regular expressions; what none of them has is the rest.
CLASSES = {
    "lower": "a-z",
    "upper": "A-Z",
    "digit": "0-9",
    "space": r"\x20\x09-\x0D",
    "stop": ".,;:!?'\"()-",
    "symbol": "#*$%&|<>",
}
BLANK = r"[\x20\x09-\x0D]+"


def _let(value: Column, body) -> Column:
    """`body` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _word_positions_repeated(hashes: Column) -> Column:
    """Places, in order, whose value occurs more than once; few different repeats are looked up, many are sorted."""

    def of(h: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(h) - 1)
        repeats = _let(F.sort_array(h), lambda s: F.array_distinct(F.filter(s, lambda x, i: (i > 0) & (x == F.get(s, i - 1)))))

        def looked_up(d: Column) -> Column:
            return F.filter(places, lambda i: F.array_contains(d, F.get(h, i)))

        pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        same = _let(pairs, lambda p: F.transform(F.filter(p, lambda x, k: ((k > 0) & (F.get(p, k - 1)["h"] == x["h"])) | (F.get(p, k + 1)["h"] == x["h"])), lambda x: x["i"]))
        return _let(repeats, lambda d: F.when(F.size(d) == 0, F.array().cast("array<int>")).when(F.size(d) <= 16, looked_up(d)).otherwise(F.sort_array(same)))

    return _let(hashes, of)


def n_repeat_words(words: Column) -> Column:
    """Words inside 3-word windows that occur at least twice. Windows are told apart by their 64-bit hash."""

    def of(w: Column) -> Column:
        hashes = F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
        gaps = _let(_word_positions_repeated(hashes), lambda p: F.aggregate(F.transform(p, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(p, k + 1) - x, F.lit(3)))), F.lit(0), lambda a, b: a + b))
        return F.when(F.size(w) < 4, F.lit(0)).otherwise(gaps)

    return _let(words, of).cast("long")


def _share(counts: list[Column], total: Column) -> Column:
    return F.array(*[F.when(total > 0, c / total).otherwise(F.lit(0.0)) for c in counts])


def _distance(p: Column, q: list[float]) -> Column:
    """Jensen-Shannon distance to a fixed histogram."""

    def term(a: Column, b: Column) -> Column:
        own = F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(F.lit(0.0))
        return own + F.when(b > 0, b * F.log2(2 * b / (a + b))).otherwise(F.lit(0.0))

    parts = F.zip_with(p, F.array(*map(F.lit, q)), term)
    total = F.aggregate(parts, F.lit(0.0), lambda x, y: x + y)
    return F.sqrt(F.greatest(total / 2, F.lit(0.0)))


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per document: id, lang, the base counts, and the two histograms."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{lang_col}`").alias("lang"), text.alias("t"))
    listed = sorted({w for ws in COMMON_WORDS.values() for w in ws})
    lines = F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))

    def words_of(w: Column) -> Column:
        common = F.filter(F.transform(w, lambda x: F.lower(x)), lambda x: x.isin(listed))
        n = F.size(w)

        def shares(c: Column) -> Column:
            return _share([*(F.size(c) - F.size(F.array_remove(c, x)) for x in listed), n - F.size(c)], n)

        return F.struct(n.cast("long").alias("n_words"), F.length(F.array_join(w, "")).cast("long").alias("word_chars"), n_repeat_words(w).alias("n_repeat_words"), _let(common, shares).alias("common"))

    counts = {k: F.length("t") - F.length(F.regexp_replace("t", f"[{c}]+", "")) for k, c in CLASSES.items()}
    found = rows.select(
        "doc_id",
        "lang",
        _let(F.array_remove(F.split("t", BLANK), ""), words_of).alias("w"),
        _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        F.length("t").alias("n_chars"),
        *[c.cast("long").alias(k) for k, c in counts.items()],
    )
    rest = F.col("n_chars") - sum((F.col(c) for c in CLASSES), F.lit(0))
    return found.select(
        "doc_id", "lang", "w.n_words", "w.word_chars", F.col("symbol").alias("n_symbols"), "n_dup_lines", "w.n_repeat_words",
        "w.common", _share([*(F.col(c) for c in CLASSES), rest], F.col("n_chars")).alias("classes"),
    )


def references(rows: DataFrame) -> dict[str, tuple[list[float], list[float]]]:
    """Mean histograms (classes, common words) of the rows of each reference language."""
    n_classes, n_words = len(CLASSES) + 1, len({w for ws in COMMON_WORDS.values() for w in ws}) + 1
    means = [F.avg(F.get("classes", F.lit(i))).alias(f"c{i}") for i in range(n_classes)] + [F.avg(F.get("common", F.lit(i))).alias(f"w{i}") for i in range(n_words)]
    known = rows.filter(F.col("lang").isin(*COMMON_WORDS)).groupBy("lang").agg(*means)
    return {r["lang"]: ([r[f"c{i}"] for i in range(n_classes)], [r[f"w{i}"] for i in range(n_words)]) for r in known.collect()}


def _nearest(column: str, known: list[list[float]]) -> Column:
    distances = [_distance(F.col(column), q) for q in known]
    return F.least(*distances) if len(distances) > 1 else distances[0] if distances else F.lit(0.0)


def judge(
    docs: DataFrame,
    max_class_distance: float = 0.12,
    length_allowance: float = 1.1,
    trim_distance: float = 0.2,
    max_word_distance: float = 0.6,
    min_words_classes: int = 50,
    min_words_common: int = 100,
    **columns: str,
) -> DataFrame:
    """Base counts, base_failed, the distances to the nearest reference, and kept, one row per row of `docs`.

    Texts of any length count whole; repeated rows are each judged alike; an empty table gives no rows.

    Null and empty texts count as no words and fail the base rule. Documents below a minimum length skip that
    distance, and all skip both where no document of a reference language exists. Columns other than id, text and
    language are not read. The limit for classes is `max_class_distance` plus `length_allowance` over the root of the
    number of words, as the histograms of short texts scatter.
    """
    from .scratch import stored

    rows = stored(measured(docs, **columns), "measured")
    long = rows.filter(F.col("n_words") >= min_words_common)
    known = references(long)
    # Once more without the documents that are far from all of these, so that junk does not shape the references.
    known = references(long.filter(_nearest("classes", [c for c, _ in known.values()]) <= trim_distance)) or known

    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    far = ((F.col("n_words") >= min_words_classes) & (F.col("class_distance") > max_class_distance + length_allowance / F.sqrt("n_words"))) | ((F.col("n_words") >= min_words_common) & (F.col("word_distance") > max_word_distance))
    judged = rows.withColumns({"class_distance": _nearest("classes", [c for c, _ in known.values()]), "word_distance": _nearest("common", [w for _, w in known.values()]), "base_failed": failed})
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & ~far).alias("kept"), "class_distance", "word_distance")
