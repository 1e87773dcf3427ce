"""Fill-in-the-middle: a text cut at two unit boundaries and put into another order, by one match of a counted pattern."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import packed

# A unit is a line with its line feed, or a last line without; the marks stand before prefix, suffix and middle.
LINE = r"[^\n]*\n|[^\n]+"
MARKS = ("<P>", "<S>", "<M>")


def _checked(marks: tuple[str, str, str]) -> tuple[str, str, str]:
    """Marks whose first character stands nowhere else in them: then no mark can arise across a cut, and none hides in another."""
    for mark in marks:
        others = [other for other in marks if other is not mark]
        if not mark or any(m[0] in n[1:] for m in marks for n in marks) or any(other.startswith(mark) for other in others):
            raise ValueError("a mark's first character must stand in no other place of a mark, and no mark may begin another")
    return marks


def _draw(digest: Column, number: int) -> Column:
    """The ``number``-th group of eight hexadecimal digits as an unsigned integer."""
    return F.conv(F.substring(digest, 8 * number - 7, 8), 16, 10).cast("long")


def _split(output: Column, marks: tuple[str, str, str]) -> Column:
    """What stands between the marks of a rearranged text; the first element is what stands before the first mark."""
    return F.split(output, "|".join(rf"\Q{mark}\E" for mark in marks), -1)


def _pieces(output: Column, form: Column, marks: tuple[str, str, str]) -> Column:
    """Prefix, middle and suffix as a struct; null for plain texts."""
    parts = _split(output, marks)
    psm = F.struct(F.get(parts, F.lit(1)).alias("prefix"), F.get(parts, F.lit(3)).alias("middle"), F.get(parts, F.lit(2)).alias("suffix"))
    spm = F.struct(F.get(parts, F.lit(2)).alias("prefix"), F.get(parts, F.lit(3)).alias("middle"), F.get(parts, F.lit(1)).alias("suffix"))
    return F.when(form == "psm", psm).when(form == "spm", spm)


def restored(output: Column, form: Column, marks: tuple[str, str, str] = MARKS) -> Column:
    """The text that became ``output`` in this form."""
    pieces = _pieces(output, form, _checked(marks))
    return F.when(form == "plain", output).otherwise(F.concat(pieces["prefix"], pieces["middle"], pieces["suffix"]))


def fill_in_middle(
    docs: DataFrame,
    unit: str = LINE,
    marks: tuple[str, str, str] = MARKS,
    seed: str = "7",
    fim_percent: int = 100,
    spm_percent: int = 50,
    keep: list[str] | None = None,
) -> DataFrame:
    """The columns ``keep`` (by default all) of every row of ``docs`` (doc_id, text) as the struct ``_row``, with n, form,
    prefix_chars, middle_chars and output.

    ``unit`` is a regular expression without capturing groups whose matches, left to right, cover any text without gaps; n counts
    them. Four numbers drawn from the sha256 of seed, colon and doc_id give two cuts (each 0 to n units) and the form: ``plain`` is the
    text itself, ``psm`` has prefix, suffix, middle behind their marks, ``spm`` suffix, prefix, middle. One match of
    ``(unit{a}+)(unit{b-a}+)(rest)``, whose possessive counts are met by iteration and never given back, captures all three
    parts and writes the output.

    A null text counts as empty; empty texts and texts with a mark in them stay plain. A null doc_id is drawn as if it were empty.
    Rows that share a doc_id are cut by the same draws. Texts of any length are matched whole, in memory proportional to the text. Rows
    are independent: nothing is shuffled, a lost task is repeated alike, and an empty table gives an empty result. Extra columns,
    whatever their names, stay in ``_row``.
    """
    marks = _checked(marks)
    names = docs.columns if keep is None else keep
    row = F.struct(*[F.col(f"_row.`{c}`").alias(c) for c in names]).alias("_row")
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_text")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256).alias("_digest")
    rows = packed(docs, text, digest).select(row, "_text", "_digest")
    rows = rows.withColumn("n", F.regexp_count("_text", F.lit(unit)).cast("long"))
    one, two = (_draw(F.col("_digest"), k) % (F.col("n") + 1) for k in (1, 2))
    rows = rows.withColumns({"_a": F.least(one, two), "_b": F.greatest(one, two)})
    marked = F.lit(False)
    for mark in marks:
        marked = marked | F.contains("_text", F.lit(mark))
    plain = (F.col("_text") == "") | marked | (_draw(F.col("_digest"), 3) % 100 >= fim_percent)
    form = F.when(plain, "plain").when(_draw(F.col("_digest"), 4) % 100 < spm_percent, "spm").otherwise("psm")
    rows = rows.withColumn("form", form)
    counted = [F.concat(F.lit(f"((?:{unit}){{"), count.cast("string"), F.lit("}+)")) for count in (F.col("_a"), F.col("_b") - F.col("_a"))]
    pattern = F.concat(F.lit(r"\A"), *counted, F.lit(r"((?s:.*))\z"))
    p, s, m = (re.sub(r"([\\$])", r"\\\1", mark) for mark in marks)
    psm = F.regexp_replace("_text", pattern, F.lit(f"{p}$1{s}$3{m}$2"))
    spm = F.regexp_replace("_text", pattern, F.lit(f"{s}$3{p}$1{m}$2"))
    rows = rows.withColumn("output", F.when(F.col("form") == "psm", psm).when(F.col("form") == "spm", spm).otherwise(F.col("_text")))
    pieces = _pieces(F.col("output"), F.col("form"), marks)
    chars = {f"{part}_chars": F.length(pieces[part]).cast("long") for part in ("prefix", "middle")}
    return rows.withColumns(chars).select("_row", "n", "form", *chars, "output")
