"""SNK-6: re-canonicalise a stored table and report what changed."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adloom.functions.text import strip_foreign
from adloom.operators.resolve import normalize_listings
from adloom.session import durable
from adloom.sources.versions import VersionedTable
from adloom.sources.vocabulary import Vocabulary

ALL_FIELDS = [
    "price", "engine_size", "mileage", "year", "seats", "horsepower", "cylinders", "doors",
    "fuel_type", "transmission", "origin", "body_type", "city", "exterior_color",
    "interior_color", "condition", "make", "model",
]
COMPOUND_FIELDS = [
    "make", "model", "body_type", "fuel_type", "transmission", "condition", "city", "origin",
    "exterior_color", "interior_color",
]


def diff_columns(
    before: DataFrame, after: dict[str, str], key: str, allow_blank: bool
) -> tuple[DataFrame, DataFrame]:
    """Rows that hold old and new values side by side to ``(fixed rows, change log)``.

    ``after`` names the column with the new value of each field. A blank and a NULL are the same
    cell. Without ``allow_blank`` a new value that is blank does not replace anything.
    """
    logs, fixed = [], {}
    for field, new in after.items():
        old_text = F.coalesce(F.col(field).cast("string"), F.lit(""))
        new_text = F.coalesce(F.col(new).cast("string"), F.lit(""))
        changed = new_text != old_text
        if not allow_blank:
            changed = changed & (new_text != "")
        logs.append(
            F.when(
                changed,
                F.struct(F.lit(field).alias("field"), old_text.alias("old"), new_text.alias("new")),
            )
        )
        fixed[field] = F.when(changed, F.col(new)).otherwise(F.col(field))
    plain = [c for c in before.columns if c not in after.values()]
    rows = before.select(*[fixed[c].alias(c) if c in fixed else F.col(c) for c in plain])
    # every field of a row, of which the changed ones stay: compiled, unlike a filter inside the array
    log = before.select(key, F.inline(F.array(*logs))).filter("field IS NOT NULL")
    return rows, log


def repair_data(
    table: DataFrame,
    vocabulary: Vocabulary,
    fields: Sequence[str] = ALL_FIELDS,
    allow_blank: bool = True,
    strip_compounds: bool = False,
    key: str = "id",
) -> tuple[DataFrame, DataFrame]:
    """Normalise every row; ``(fixed table, log of (key, field, old, new))``.

    ``allow_blank`` lets a value be replaced by a blank. ``strip_compounds`` reduces bilingual
    compounds first, while the comparison is still against the stored text.
    """
    present = [f for f in fields if f in table.columns]
    work = table.withColumns({f"_old_{f}": F.col(f) for f in present})
    done = normalize_listings(work, vocabulary, {f: strip_foreign for f in COMPOUND_FIELDS} if strip_compounds else None)
    side_by_side = done.select(
        *[F.col(f"_old_{c}").alias(c) if c in present else F.col(c) for c in table.columns],
        *[F.col(f).alias(f"_new_{f}") for f in present],
    )
    return diff_columns(side_by_side, {f: f"_new_{f}" for f in present}, key, allow_blank)


def repair_stored(stored: VersionedTable, repair: Callable[[DataFrame], tuple[DataFrame, DataFrame]]) -> DataFrame:
    """SNK-6 in place: the rows that ``repair`` makes of the stored ones become the new version; gives its change log.

    Readers have the old rows until the new ones are complete, and the new version only counts if the table is
    still the one that was repaired.
    """
    version = stored.version()
    fixed, log = repair(stored.read())
    written = durable(log)
    stored.replace(fixed, after=version)
    return written
