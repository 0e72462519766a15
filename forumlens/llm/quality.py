"""Line-first quality rules, in DataFrame functions only.

Every line of a document is judged by itself: a line fails when it is
boilerplate, navigation, or lacks punctuation where prose has it. Failing lines
go; a document that loses too much of its text goes as a whole. Repetition and
length are checked on the whole document first (``base_failed``).

Defined results: null text counts as no text (no words, no lines, base_failed).
Blank lines are kept and weigh nothing. Repeated rows give repeated rows. Extra
columns of the input are kept by :func:`clean_documents` and may be called like
the measures, since all measures live in one struct column.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = r"[#*$%&|<>]"
# The last characters of a line of prose hold one of these. Marks that end or divide
# sentences, by script (Latin, CJK, Indic, Arabic, Armenian, Ethiopic, Burmese, Khmer, Tibetan, Mongolian).
SENTENCE_END = "[.!?:;,…‼⁇⁈⁉⸮。．｡！？，、；：।॥؟۔؛،՞։՝።፣፧፨၊။។៕།༎᠂᠃᠉]"
END_CHARS = 4
BOILERPLATE = (
    r"(?i)\b(enable javascript|javascript is (disabled|required)|lorem ipsum|accept (all )?cookies|uses cookies"
    r"|cookie policy|privacy policy|terms of (use|service)|all rights reserved|click here|subscribe to our"
    r"|sign up for|share this|read more|skip to content)")
BOILERPLATE_CHARS = 200      # a longer line is prose that mentions such words
NAVIGATION = r"(?i)^(home|menu|login|log in|sign in|search|next|previous|back to top|contact( us)?|about( us)?)$"
NAVIGATION_CHARS = 20
NAV_MARKS = r"(\x20[|>]\x20[^|>]*){2}"

MIN_WORDS = 50
MIN_UNPUNCTUATED_WORDS = 8   # a longer line passes without final punctuation
MAX_SYMBOL_SHARE = 0.3       # symbols to words of a line
MAX_LOST_SHARE = 0.5         # of the characters outside white space

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
            "clean_text")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once (a lambda variable)."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE), "")


def repeated_words(w: Column, n: Column) -> Column:
    """Words inside three-word windows that occur twice or more, each word once.

    Windows are compared by a 64-bit hash within their document and sorted with
    their start, so equal ones are neighbours: n log n in the document's length.
    The shortcut by distinct count skips the sort where nothing repeats.
    """
    def windows() -> Column:
        return F.transform(F.slice(w, 1, n - 2), lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))

    def starts(pairs: Column) -> Column:
        twice = F.filter(F.sequence(F.lit(0), n - 3), lambda j: (
            F.equal_null(F.get(pairs, j)["w"], F.get(pairs, j - 1)["w"])
            | F.equal_null(F.get(pairs, j)["w"], F.get(pairs, j + 1)["w"])))
        return F.transform(twice, lambda j: F.get(pairs, j)["i"])

    def covered(wins: Column) -> Column:
        pairs = F.sort_array(F.arrays_zip(wins.alias("w"), F.sequence(F.lit(0), n - 3).alias("i")))
        spread = F.flatten(F.transform(_let(pairs, starts), lambda i: F.array(i, i + 1, i + 2)))
        return F.when(F.size(F.array_distinct(wins)) == n - 2, F.lit(0)).otherwise(F.size(F.array_distinct(spread)))

    return F.when(n < 3, F.lit(0)).otherwise(_let(windows(), covered))


def line_fails(line: Column, doc_symbols: Column) -> Column:
    """True for a trimmed line that is boilerplate, navigation, mostly symbols, or an unpunctuated scrap.

    Symbols can only be found in a document that has some, so its count spares
    most lines those searches.
    """
    n = F.size(F.split(line, " +"))
    scrap = ~F.right(line, F.lit(END_CHARS)).rlike(SENTENCE_END) & (n < MIN_UNPUNCTUATED_WORDS)
    boilerplate = (F.length(line) < BOILERPLATE_CHARS) & line.rlike(BOILERPLATE)
    navigation = (F.length(line) < NAVIGATION_CHARS) & line.rlike(NAVIGATION)
    marked = (doc_symbols > 0) & (line.rlike(NAV_MARKS) | (symbols(line) > MAX_SYMBOL_SHARE * n))
    return (line != "") & (boilerplate | navigation | marked | scrap)


def symbols(text: Column) -> Column:
    return F.size(F.regexp_extract_all(text, F.lit(SYMBOLS), F.lit(0)))


def measures(text: Column) -> Column:
    """One struct with every measure and the cleaned text of a document."""
    def of_text(t: Column) -> Column:
        return _let(words(t), lambda w: _let(F.size(w), lambda n: _let(F.split(t, "\n"), lambda ls: _let(
            symbols(t), lambda k: _let(failing(ls, k), lambda judged: body(t, w, n, ls, k, judged))))))

    def failing(lines: Column, k: Column) -> Column:
        """Each line with whether it fails, judged once."""
        return F.transform(lines, lambda s: F.struct(
            s.alias("s"), _let(F.trim(s, F.lit(BLANKS)), lambda line: line_fails(line, k)).alias("fails")))

    def body(t: Column, w: Column, n: Column, lines: Column, k: Column, judged: Column) -> Column:
        worded = F.filter(lines, lambda s: F.trim(s, F.lit(BLANKS)) != "")
        bad = F.transform(F.filter(judged, lambda x: x["fails"]), lambda x: x["s"])
        left = F.when(~F.exists(judged, lambda x: x["fails"]), t).otherwise(
            F.array_join(F.transform(F.filter(judged, lambda x: ~x["fails"]), lambda x: x["s"]), "\n"))
        return _let(F.struct(
            F.length(F.array_join(w, "")).alias("chars"), _let(worded, lambda ls: F.size(ls) - F.size(
                F.array_distinct(ls))).alias("dup"), repeated_words(w, n).alias("repeat"),
            F.length(F.array_join(words(F.array_join(bad, " ")), "")).alias("lost"), left.alias("left")),
            lambda m: verdict(n, k, m))

    def verdict(n: Column, k: Column, m: Column) -> Column:
        failed = (n < MIN_WORDS) | (100 * m["repeat"] > 50 * n)
        return F.struct(
            n.cast("long").alias("n_words"), m["chars"].cast("long").alias("word_chars"),
            k.cast("long").alias("n_symbols"), m["dup"].cast("long").alias("n_dup_lines"),
            m["repeat"].cast("long").alias("n_repeat_words"), failed.alias("base_failed"),
            (~failed & (m["lost"] <= MAX_LOST_SHARE * m["chars"])).alias("kept"), m["left"].alias("clean_text"))

    return _let(F.coalesce(text, F.lit("")), of_text)


def judge(docs: DataFrame, text: str = "text", into: str = "quality") -> DataFrame:
    """``docs`` with the struct column ``into`` of :data:`MEASURES`."""
    return docs.withColumn(into, measures(F.col(text)))


def clean_documents(docs: DataFrame, text: str = "text", replace_text: bool = True) -> DataFrame:
    """The documents that pass, their failing lines removed; columns as before.

    ``replace_text=False`` keeps the passing documents' texts whole.
    """
    kept = judge(docs, text, "__quality").where(F.col("__quality.kept"))
    if replace_text:
        kept = kept.withColumn(text, F.col("__quality.clean_text"))
    return kept.drop("__quality").select(*docs.columns)


def op7_quality_rules(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return judge(docs).select("doc_id", *(f"quality.{m}" for m in MEASURES if m != "clean_text"))
