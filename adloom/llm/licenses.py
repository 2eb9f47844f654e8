"""Licence scan by sentence rules, with built-in expressions only and no shuffle.

A text is normalised and cut into sentences once; each sentence is looked up among the known licence
sentences, which leaves a short sequence of identifiers per document. Rules are ordered lists of
identifiers, matched as consecutive known sentences; other sentences (a copyright line, say) may stand
between. Where one rule's list is part of a longer one's, the longer one is taken out first.

Sentences end at ``. ! ? ; :`` before white space and at a line without letters and digits (an empty one, or
one of comment marks). Licence texts are often wrapped, and notices often stand on lines of their own, so both
readings count, sentence by sentence: it is looked up as a whole, with line breaks as blanks, and where it is
not known, each of its lines is. What either reading knows so comes into one sequence, in the order of the text.
Letters are lowered and all but letters and digits count as one blank.

``LINES`` and ``WRAPPED`` are the readings of the SQL of ``op9_license_scan``, which takes all of a text by the one
that knows more. Its rows are the same where that reading knows all that the other knows.

Defined results: null or empty text has no sentence, sequence ``''`` and no licence. Licences of a document
are listed once, sorted by name. Repeated rows give repeated results.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adloom.llm.common import text_of
from adloom.llm.license_values import RULES, SENTENCES


def normalized(sentence: str) -> str:
    return re.sub(r"[\W_]+", " ", sentence.lower()).strip()


LINES = r"[.!?;:]+[ \t\r\n]+|\n"
WRAPPED = r"[.!?;:]+[ \t\r\n]+|\n[ \t\r]*\n"
ENDS = r"[.!?;:]+[ \t\r\n]+|\n[^\p{L}\p{N}\n]*\n"


def known_sentences(text: Column, table: Column) -> Column:
    """Places in ``table`` (normalised sentences, counted from 1) of the known sentences of a text, in order."""
    cut = F.regexp_replace(F.lower(text), ENDS, "\x01")
    whole = F.split(F.regexp_replace(cut, r"[^\p{L}\p{N}\x01]+", " "), "\x01")
    lined = F.split(F.regexp_replace(cut, r"[^\p{L}\p{N}\n\x01]+", " "), "\x01")

    def place(sentence: Column) -> Column:
        return F.array_position(table, F.trim(sentence))

    def lines(sentence: Column) -> Column:
        return F.filter(F.transform(F.split(sentence, "\n"), place), lambda p: p > 0)

    return F.flatten(F.zip_with(F.transform(whole, place), lined, lambda p, s: F.when(p > 0, F.array(p)).otherwise(lines(s))))


def scan_licenses(documents: DataFrame, sentences: dict[int, str] = SENTENCES, rules: list[tuple[str, list[int]]] = RULES) -> DataFrame:
    """``doc_id``, ``sentence_ids`` (blank-separated), ``n_known``, ``licenses`` (comma-separated) per document."""
    ids = list(sentences)
    table = F.array(*[F.lit(normalized(sentences[i])) for i in ids])
    numbers = F.array(*[F.lit(i) for i in ids])

    places = known_sentences(F.col("text"), table)
    found = F.transform(places, lambda p: F.get(numbers, (p - 1).cast("int")))
    scanned = text_of(documents, "doc_id").select("doc_id", found.alias("found"))
    sequence = F.concat(F.lit(" "), F.array_join(F.transform("found", lambda i: i.cast("string")), "  "), F.lit(" "))
    left, names = sequence, []
    for name, order in sorted(rules, key=lambda r: (-len(r[1]), r[0], r[1])):
        shown = "  ".join(map(str, order))
        names.append(F.when(F.contains(left, F.lit(f" {shown} ")), F.lit(name)))
        left = F.replace(left, F.lit(f" {shown} "), F.lit(" - "))
    licenses = F.array_join(F.array_sort(F.array_distinct(F.array_compact(F.array(*names)))), ",")
    return scanned.select(
        "doc_id",
        F.array_join(F.transform("found", lambda i: i.cast("string")), " ").alias("sentence_ids"),
        F.size("found").cast("bigint").alias("n_known"),
        licenses.alias("licenses"),
    )
