"""Line-first cleaning: rules judge each line, failing lines go, and documents that lose too much are rejected.

Only DataFrame functions; one pass without a shuffle.  A line fails where one of
these holds:

* punctuation: it holds no sentence mark, or three symbols or more that are over
  SYMBOL_SHARE of its characters, or it is all in capitals (and not short);
* navigation: it is a list of short entries between bars or arrows;
* boilerplate: it is short and holds a phrase of licences, cookie notices and the like.

A document is rejected if it fails the base rules (under MIN_WORDS words, or over
MAX_REPEAT of its words in repeated windows of WINDOW words), or if its remaining
lines have under KEEP_SHARE of its words.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_names

MIN_WORDS, WINDOW, MAX_REPEAT = 20, 8, 30
KEEP_SHARE, SYMBOL_SHARE, BOILERPLATE_CHARS = 0.5, 0.05, 200
SPACE = " \t\n\x0b\f\r"
SYMBOLS = r"[#*$%&|<>]+"
SENTENCE_MARK = r"[.!?…。！？।؟]"
SEPARATORS = r"\s[|›»·•>]\s"
#: Phrases of licences, cookie notices, newsletters and buttons in English, German, French and Spanish; ends are ASCII letters, where \b is the same everywhere.
BOILERPLATE = (
    r"(?i)\b(?:politique de confidentialit|(?:licen[sc]ed under|released under|(?:apache|general public|mit|bsd|creative commons) licen[sc]e|all rights reserved"
    r"|terms of (?:use|service)|privacy policy|cookie policy|(?:uses?|accept(?: all)?) cookies|enable javascript|sign up for|subscribe to our"
    r"|click here|read more|powered by|lorem ipsum"
    r"|alle rechte vorbehalten|lizenziert unter|nutzungsbedingungen|datenschutzerkl[aäÄ]rung|verwendet cookies|cookies (?:zu|akzeptieren|ablehnen|verwenden)|javascript aktivieren|newsletter (?:abonnieren|anmelden)|hier klicken|mehr lesen|weiterlesen"
    r"|tous droits r[eéÉ]serv[eéÉ]s|sous licence|conditions d.utilisation|utilise des cookies|accepter les cookies|activer javascript|abonnez.vous|cliquez ici|lire la suite"
    r"|todos los derechos reservados|bajo (?:la )?licencia|t[eéÉ]rminos de uso|condiciones de uso|pol[iíÍ]tica de (?:privacidad|cookies)|(?:utiliza|aceptar) cookies|activar javascript|haga clic|leer m[aáÁ]s)\b)"
)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value worked out once, however often the body or its lambdas use it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def strip(text: Column) -> Column:
    return F.trim(text, F.lit(SPACE))


def words_of(text: Column) -> Column:
    """Runs of characters other than space and tab to carriage return."""
    bare = strip(text)
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, r"[\x20\x09-\x0D]+"))


def n_words_of(text: Column) -> Column:
    bare = strip(text)
    return F.when(bare == "", F.lit(0)).otherwise(F.size(F.split(bare, r"[\x20\x09-\x0D]+")))


def repeated_words(words: Column) -> Column:
    """Words covered by windows of WINDOW words that occur twice or more, the first included."""

    def covered(hashes: Column) -> Column:
        marked = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def twice(s: Column) -> Column:
            n = F.size(s)

            def again(x: Column, j: Column) -> Column:
                before = (j > 0) & (F.get(s, j - 1)["h"] == x["h"])
                after = (j < n - 1) & (F.get(s, j + 1)["h"] == x["h"])
                return before | after

            return F.array_sort(F.transform(F.filter(s, again), lambda x: x["i"]))

        def spread(p: Column) -> Column:
            start = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("long").alias("sum"))
            step = lambda a, i: F.struct(i.alias("last"), (a["sum"] + F.least(F.lit(WINDOW), i - a["last"])).alias("sum"))
            return F.aggregate(p, start, step, lambda a: a["sum"])

        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(spread(let(marked, twice)))

    def counted(w: Column) -> Column:
        hashes = F.transform(F.sequence(F.lit(0), F.size(w) - WINDOW), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)]))
        return F.when(F.size(w) <= WINDOW, F.lit(0).cast("long")).otherwise(let(hashes, covered))

    return let(words, counted)


def line_passes(line: Column) -> Column:
    n = F.length(line)
    symbols = n - F.length(F.regexp_replace(line, SYMBOLS, ""))
    shout = (n >= 20) & (F.upper(line) == line) & (F.lower(line) != line)
    bars = F.size(F.split(line, SEPARATORS)) - 1
    navigation = (bars >= 3) & (bars * 5 >= n_words_of(line))
    boilerplate = (n <= BOILERPLATE_CHARS) & line.rlike(BOILERPLATE)
    return line.rlike(SENTENCE_MARK) & ((symbols < 3) | (symbols <= n * F.lit(SYMBOL_SHARE))) & ~shout & ~navigation & ~boilerplate


def clean_lines(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines_failed (long), base_failed, kept (boolean) and cleaned (string).

    A null text counts as empty and is rejected; ``cleaned`` is then the empty string.
    Lines without a word stay in ``cleaned`` and are no loss.  Repeated rows are
    judged alike.  Columns of ``df`` that have the names of the new ones are
    replaced.  An empty table stays empty.
    """
    new = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines_failed", "base_failed", "kept", "cleaned")
    rest = df.select(*[c for c in df.columns if c not in new])
    of_w, of_l, judged, failed, lost = free_names([*df.columns, *new], "_w", "_l", "_judged", "_failed", "_lost")
    t = F.coalesce(F.col(text), F.lit(""))
    # each line once with its verdict
    judge = lambda x: F.struct(x.alias("line"), ((strip(x) != "") & ~line_passes(x)).alias("failed"))
    of_words = lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"), F.length(F.array_join(w, "")).cast("long").alias("word_chars"), repeated_words(w).alias("n_repeat_words")
    )
    of_lines = lambda x: F.struct((F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"))
    lines = lambda x: F.transform(x, lambda y: y["line"])
    out = (
        rest.withColumns({of_w: let(words_of(t), of_words), of_l: let(F.filter(F.split(t, "\n"), lambda x: strip(x) != ""), of_lines), judged: F.transform(F.split(t, "\n"), judge)})
        .withColumn(failed, F.filter(judged, lambda x: x["failed"]))
        .withColumns({"n_words": F.col(of_w)["n_words"], "word_chars": F.col(of_w)["word_chars"], "n_symbols": (F.length(t) - F.length(F.regexp_replace(t, SYMBOLS, ""))).cast("long")})
        .withColumns({"n_dup_lines": F.col(of_l)["n_dup_lines"], "n_repeat_words": F.col(of_w)["n_repeat_words"], "n_lines_failed": F.size(failed).cast("long")})
        .withColumn(lost, F.aggregate(failed, F.lit(0), lambda a, x: a + n_words_of(x["line"])))
        .withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT * F.col("n_words")))
        .withColumn("kept", ~F.col("base_failed") & (F.col("n_words") - F.col(lost) >= F.col("n_words") * F.lit(KEEP_SHARE)))
    )
    cleaned = F.when(F.size(failed) == 0, t).otherwise(F.array_join(lines(F.filter(judged, lambda x: ~x["failed"])), "\n"))
    return out.withColumn("cleaned", cleaned).select(*rest.columns, *new)
