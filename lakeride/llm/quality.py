"""Quality rules: repetition and length rules, then the divergence of a document's
character-class and common-word histograms from its language's reference.

Only DataFrame functions. One pass over the texts makes a narrow table of
counts, written once; references are sums of these counts by language, and the
verdict compares each row with the reference of its language.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize

WHITE = " \t\n\x0b\f\r"
MIN_WORDS, MAX_REPEAT_PCT, SPAN = 10, 20, 5
#: a histogram is compared only if it has so many entries
LEAST_CHARS, LEAST_WORDS = 300, 100
#: the characters of a language are a reference if so many documents pass the base rules
LEAST_DOCS = 20
#: largest Jensen-Shannon distances (base 2, so from 0 to 1) of a kept document
MAX_CHAR_DISTANCE, MAX_WORD_DISTANCE = 0.34, 0.285

# Frequent function words of the languages whose documents are checked by words.
COMMON_WORDS = {
    "en": ("the", "of", "and", "to", "in", "a", "is", "that", "for", "on", "with", "was"),
    "de": ("der", "die", "und", "in", "den", "von", "zu", "das", "mit", "ist", "auf", "für"),
    "fr": ("de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est"),
    "es": ("de", "la", "que", "el", "en", "y", "los", "del", "se", "las", "por", "un"),
}
#: histogram bins of characters inside words; whatever else is there is the last bin
#: (small letters of ASCII for the most part)
CHAR_CLASSES = ("[A-Z]", "[0-9]", "[^\\x00-\\x7F]", "[.,;:!?'\"()-]", "[#*$%&|<>]")


def _long(c: Column) -> Column:
    return c.cast("long")


def words_of(text: Column) -> Column:
    """Runs of characters other than white space (space, tab to carriage return)."""
    inner = F.btrim(text, F.lit(WHITE))
    return F.when(F.length(inner) > 0, F.split(inner, "[\\x20\\x09-\\x0D]+")).otherwise(F.array().cast("array<string>"))


def repeated_words(words: Column, span: int = SPAN) -> Column:
    """Words that lie in a window of ``span`` words found twice or more.

    Hashes show quickly that all windows of a text differ (equal windows have
    equal hashes). Other texts sort (hash, position), so equal windows meet;
    should neighbours share a hash and differ, the windows themselves are
    sorted instead. The cost stays near the text's length.
    """
    windows = F.size(words) - (span - 1)
    later = lambda at, k: F.get(words, at + k)
    hash_of = lambda w, i: F.xxhash64(w, *(later(i, k) for k in range(1, span)))
    by_hash = F.sort_array(F.slice(F.transform(words, lambda w, i: F.struct(hash_of(w, i).alias("w"), i.alias("i"))), 1, windows))
    by_text = F.sort_array(F.slice(F.transform(words, lambda w, i: F.struct(
        F.concat_ws(" ", w, *(later(i, k) for k in range(1, span))).alias("w"), i.alias("i"))), 1, windows))
    # a one-element array binds a value to a lambda variable, so it is computed once
    bind = lambda value, use: F.get(F.transform(F.array(value), use), F.lit(0))

    def clash(s: Column) -> Column:
        return F.size(
            F.filter(s, lambda x, j: F.when(x.w == F.get(s, j + 1).w, ~F.lit(True).eqNullSafe(
                _all(later(x.i, k) == later(F.get(s, j + 1).i, k) for k in range(span)))).otherwise(False))) > 0

    def covered(s: Column) -> Column:
        again = F.sort_array(F.transform(F.filter(s, lambda x, j: F.coalesce(x.w == F.get(s, j - 1).w, F.lit(False))
                                                  | F.coalesce(x.w == F.get(s, j + 1).w, F.lit(False))), lambda x: x.i))
        return bind(again, lambda p: F.aggregate(
            F.transform(p, lambda at, k: F.least(F.lit(span), F.coalesce(F.get(p, k + 1) - at, F.lit(span)))),
            F.lit(0), lambda total, x: total + x))

    hashes = F.slice(F.transform(words, hash_of), 1, windows)
    some = bind(by_hash, lambda s: F.when(clash(s), bind(by_text, covered)).otherwise(covered(s)))
    return F.when(windows < 2, 0).when(F.size(F.array_distinct(hashes)) == windows, 0).otherwise(some)


def _all(conditions) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c
    return out


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Counts of each document: the base metrics and the two histograms (chars, common)."""
    white_line = lambda line: F.btrim(line, F.lit(WHITE)) != ""
    base = docs.select(docs[id_col].alias("doc_id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"),
                       docs[lang_col].cast("string").alias("lang"))
    split = base.select("doc_id", "lang", words_of(F.col("text")).alias("words"),
                        F.filter(F.split("text", "\n"), white_line).alias("lines"))
    frequent = sorted({f for ws in COMMON_WORDS.values() for w in ws for f in (w, w.capitalize(), w.upper())})
    split = split.select(
        "doc_id", "lang", F.size("words").alias("n"), F.array_join("words", "").alias("inside"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).alias("dup_lines"),
        repeated_words(F.col("words")).alias("repeat_words"),
        # every frequent word between two spaces of its own
        F.concat(F.lit(" "), F.lower(F.array_join(F.filter("words", lambda w: w.isin(*frequent)), "  ")), F.lit(" ")).alias("common"))
    total = F.length("inside")
    chars = [total - F.length(F.regexp_replace("inside", c, "")) for c in CHAR_CLASSES]
    wide = CHAR_CLASSES.index("[^\\x00-\\x7F]")  # as many bytes as characters: none of these
    chars[wide] = F.when(F.octet_length("inside") == total, 0).otherwise(chars[wide])
    count = lambda w: ((F.length("common") - F.length(F.replace("common", F.lit(f" {w} "), F.lit("")))) / (len(w) + 2)).cast("long")
    common = F.lit(None).cast("array<bigint>")
    for lang, ws in COMMON_WORDS.items():
        common = F.when(F.col("lang") == lang, F.array(*map(count, ws))).otherwise(common)
    out = split.select(
        "doc_id", "lang", _long(F.col("n")).alias("n_words"), _long(total).alias("word_chars"),
        F.array(*map(_long, chars)).alias("chars"), common.alias("common"),
        _long(F.col("dup_lines")).alias("n_dup_lines"), _long(F.col("repeat_words")).alias("n_repeat_words"))
    rest = lambda a, n: F.concat(a, F.array(n - F.aggregate(a, F.lit(0).cast("long"), lambda s, x: s + x)))
    return out.select(
        "doc_id", "lang", "n_words", "word_chars", F.element_at("chars", len(CHAR_CLASSES)).alias("n_symbols"),
        "n_dup_lines", "n_repeat_words",
        ((F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words"))).alias("base_failed"),
        rest(F.col("chars"), F.col("word_chars")).alias("chars"), rest(F.col("common"), F.col("n_words")).alias("common"))


def references(counts: DataFrame) -> DataFrame:
    """Histograms of each language (and of all, lang null) over the documents that pass the base rules.

    ref_chars is null where fewer than ``LEAST_DOCS`` passed; languages with no reference at all are left out.
    """
    good = counts.where(~F.col("base_failed"))
    bins = len(CHAR_CLASSES) + 1
    sums = [F.coalesce(F.sum(F.get("chars", F.lit(i))), F.lit(0)).alias(f"c{i}") for i in range(bins)]
    own = len(next(iter(COMMON_WORDS.values()))) + 1
    word_sums = [F.coalesce(F.sum(F.get("common", F.lit(i))), F.lit(0)).alias(f"w{i}") for i in range(own)]
    total = good.groupBy("lang").agg(*sums, *word_sums, F.count("*").alias("n"))
    both = total.where("lang is not null").unionByName(
        total.agg(*(F.sum(f"c{i}").alias(f"c{i}") for i in range(bins)), F.sum("n").alias("n")).select(
            F.lit(None).cast("string").alias("lang"), "*", *(F.lit(None).cast("long").alias(f"w{i}") for i in range(own))))
    return both.where((F.col("n") >= LEAST_DOCS) | F.col("lang").isin(*COMMON_WORDS)).select(
        "lang", F.when(F.col("n") >= LEAST_DOCS, F.array(*(f"c{i}" for i in range(bins)))).alias("ref_chars"),
        F.array(*(f"w{i}" for i in range(own))).alias("ref_common"))


def js_distance(a: Column, b: Column) -> Column:
    """Jensen-Shannon distance (base 2) of two count arrays; null if either is null or all zero."""
    total = lambda x: F.aggregate(x, F.lit(0.0), lambda s, v: s + v)
    part = lambda p, m: F.when(p > 0, p * F.log2(p / m)).otherwise(0.0)
    ta, tb = total(a), total(b)
    each = F.zip_with(a, b, lambda x, y: (part(x / ta, (x / ta + y / tb) / 2) + part(y / tb, (x / ta + y / tb) / 2)) / 2)
    return F.when((ta > 0) & (tb > 0), F.sqrt(F.greatest(F.lit(0.0), total(each))))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per input row: doc_id, the base metrics, base_failed, both distances and kept.

    Null and empty texts have zero counts and fail the base rules. Each lang has
    its own character reference; where that is too small there is no character
    comparison, and only the languages of ``COMMON_WORDS`` are compared by
    words. A null lang is compared with the characters of all languages.
    Histograms below the guards are not compared (distance null). Repeated rows
    give repeated rows, an empty table none. Other columns are ignored, whatever
    their names. The references are a row for each language.
    """
    counts = materialize(measure(docs, id_col, text_col, lang_col), "quality-counts")
    refs = references(counts)
    joined = counts.join(F.broadcast(refs), counts["lang"].eqNullSafe(refs["lang"]), "left")
    chars = F.when(F.col("word_chars") >= LEAST_CHARS, js_distance(F.col("chars"), F.col("ref_chars")))
    words = F.when(F.col("n_words") >= LEAST_WORDS, js_distance(F.col("common"), F.col("ref_common")))
    out = joined.select(counts["doc_id"], "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                        chars.alias("char_distance"), words.alias("word_distance"))
    return out.withColumn("kept", ~F.col("base_failed") & ~(
        F.coalesce(F.col("char_distance") > MAX_CHAR_DISTANCE, F.lit(False))
        | F.coalesce(F.col("word_distance") > MAX_WORD_DISTANCE, F.lit(False))))
