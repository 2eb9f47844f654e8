"""Landed API payloads: envelopes of items with uncertain shape (SRC-1 to SRC-4)."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adloom.functions import fixed_values as V
from adloom.functions.markup import once
from adloom.functions.text import clean, is_any

ITEMS = "array<variant>"


def envelope_items(
    body: Column, keys: Sequence[str] = V.ENVELOPE_KEYS, require_non_empty: bool = False
) -> Column:
    """SRC-1/SRC-2: the payload itself when it is a list, else the first key that holds a list.

    With ``require_non_empty`` empty lists are passed over.
    """
    found = [F.try_variant_get(body, path, ITEMS) for path in ["$", *[f"$.{k}" for k in keys]]]
    if require_non_empty:
        found = [F.when(F.size(x) > 0, x) for x in found]
    return F.coalesce(*found)


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """One row per landed response file: ``path``, ``body`` (text)."""
    return spark.read.text(path, wholetext=True).select(
        F.input_file_name().alias("path"), F.col("value").alias("body")
    )


def explode_items(
    payloads: DataFrame,
    body: str = "body",
    keys: Sequence[str] = V.ENVELOPE_KEYS,
    require_non_empty: bool = False,
) -> DataFrame:
    """Items of every payload as variants, with their position; unparseable bodies give none."""
    kept = [c for c in payloads.columns if c != body]
    items = envelope_items(F.try_parse_json(F.col(body)), keys, require_non_empty)
    return payloads.select(*kept, F.posexplode(items).alias("pos", "item"))


def read_envelope_json(
    spark: SparkSession,
    path: str,
    keys: Sequence[str] = V.ENVELOPE_KEYS,
    require_non_empty: bool = False,
) -> DataFrame:
    return explode_items(read_payloads(spark, path), "body", keys, require_non_empty)


def _integer(body: Column, path: str) -> Column:
    kind = F.schema_of_variant(F.try_variant_get(body, path, "variant"))
    return F.when(kind == "BIGINT", F.try_variant_get(body, path, "int"))


def envelope_total(body: Column) -> Column:
    """SRC-3: announced number of items."""
    paths = []
    for key in [*V.TOTAL_KEYS, "meta"]:
        paths += [f"$.{key}"] + [f"$.{key}.{inner}" for inner in V.META_TOTAL_KEYS]
    return F.coalesce(*[_integer(body, p) for p in paths])


def last_page(body: Column) -> Column:
    """SRC-3: last page announced by the pagination block."""
    return F.try_variant_get(body, "$.pagination.last_page", "int")


def is_listing_payload(
    url: Column, body: Column, keys: Sequence[str] = V.ENVELOPE_KEYS, marker: str = V.LISTING_MARKER
) -> Column:
    """SRC-4: a marked URL whose first item is an object with a price or a publication date."""
    first = F.try_element_at(envelope_items(body, keys), F.lit(1))
    priced = F.coalesce(
        F.try_variant_get(first, "$.price", "variant"),
        F.try_variant_get(first, "$.published_date", "variant"),
    )
    return F.coalesce(url.contains(marker) & priced.isNotNull(), F.lit(False))


# --- access to variant items ---------------------------------------------------------------------
# JSON spellings of values that count as missing.
FALSY = ["null", '""', "0", "0.0", "false", "[]", "{}"]


def object_type(members: Mapping[str, str]) -> str:
    """Type of an object of which only the named members are read."""
    return "struct<" + ",".join(f"`{name}`:{kind}" for name, kind in members.items()) + ">"


def members(item: Column, kinds: Mapping[str, str]) -> Column:
    """Named members of an object, read in one walk over those it has; null for what is no object.

    A path to a member that is missing ends in an exception inside Spark, which costs as much as reading a
    whole item, so members that may be missing are read with this.
    """
    return F.try_variant_get(item, "$", object_type(kinds))


def member(key: str, *items: Column) -> Column:
    """MRG-2: the member of the first item that has the key, even if its value is null or blank."""
    return F.coalesce(*[members(i, {key: "variant"})[key] for i in items])


# What those read as; a text that reads so is no such value, which only its JSON spelling tells.
_DOUBTFUL = ["", "0", "0.0", "false", "[]", "{}"]


def _unless_falsy(text: Column, value: Column) -> Column:
    """``text`` of the variant ``value``, which is looked at only if the text leaves doubt."""
    doubt = (F.octet_length(text) <= max(map(len, _DOUBTFUL))) & is_any(text, _DOUBTFUL)
    return F.when(doubt, once(F.to_json(value), lambda json: F.when(~is_any(json, FALSY), text))).otherwise(text)


def truthy(value: Column) -> Column:
    """Text of a variant; blank, zero, false, empty and null are NULL."""
    return _unless_falsy(F.try_variant_get(value, "$", "string"), value)


def first_truthy(values: Sequence[Column]) -> Column:
    """First truthy text among variants. Inside a lambda nothing is shared, so a text is bound before it is looked at."""

    def text(value: Column) -> Column:
        return once(F.try_variant_get(value, "$", "string"), lambda t: _unless_falsy(t, value))

    return F.coalesce(*[text(v) for v in values])


def pick(keys: Sequence[str], *items: Column) -> Column:
    """First truthy member among several key spellings, merged over ``items``."""
    kinds = dict.fromkeys(keys, "variant")

    def merged(read: Sequence[Column]) -> Column:
        return first_truthy([F.coalesce(*[r[k] for r in read]) for k in keys])

    return once(F.struct(*[members(i, kinds).alias(f"i{n}") for n, i in enumerate(items)]),
                lambda all_: merged([all_[f"i{n}"] for n in range(len(items))]))


def pick_clean(keys: Sequence[str], *items: Column) -> Column:
    return clean(pick(keys, *items))


def with_texts(
    df: DataFrame,
    wanted: Mapping[str, Sequence[str]],
    *items: Column,
    tidy: Callable[[Column], Column] | None = clean,
    plain: Sequence[str] = (),
) -> DataFrame:
    """Add a text column per entry of ``wanted``: the first truthy of several dotted paths.

    The first key of a path is looked up over ``items`` as in :func:`member`. All but the ``plain``
    columns go through ``tidy``. Paths of one depth are read together, as texts in nested structs, so that
    an item is walked once per depth. Reads, texts and tidied texts are projections of their own, so that
    nothing is looked up twice however often a column is used later. Texts are bound by :func:`once`, which
    also keeps so many columns out of one generated method: the JVM compiles none of more than 8,000 bytes.
    """
    paths = list(dict.fromkeys(p for alternatives in wanted.values() for p in alternatives))
    out, sources = df, {"": items[0]}
    if len(items) > 1:  # which item has a key shows in a variant only
        tops = list(dict.fromkeys(p.split(".")[0] for p in paths))
        kinds = dict.fromkeys(tops, "variant")
        out = out.withColumns({f"_item_{n}": members(i, kinds) for n, i in enumerate(items)})
        out = out.withColumns({f"_member_{k}": F.coalesce(*[F.col(f"_item_{n}")[k] for n in range(len(items))]) for k in tops})
        sources = {k: F.col(f"_member_{k}") for k in tops}
    asked = {p: ("", p.split(".")) if len(items) == 1 else (p.split(".")[0], p.split(".")[1:]) for p in paths}
    together: dict[tuple[str, int], list[list[str]]] = {}
    for source, keys in asked.values():
        together.setdefault((source, len(keys)), []).append(keys)
    reads = {read: f"_read_{n}" for n, read in enumerate(together)}
    out = out.withColumns({name: F.try_variant_get(sources[read[0]], "$", _texts_type(together[read])) for read, name in reads.items()})

    def text(path: str) -> Column:
        source, keys = asked[path]
        found = F.col(reads[source, len(keys)])
        for key in keys:
            found = found[key]
        return once(found, lambda t: _unless_falsy(t, F.try_variant_get(sources[source], ".".join(["$", *keys]), "variant")))

    out = out.withColumns({f"_text_{i}": text(p) for i, p in enumerate(paths)})
    first = {
        name: F.coalesce(*[F.col(f"_text_{paths.index(p)}") for p in alternatives])
        for name, alternatives in wanted.items()
    }
    out = out.select(*df.columns, *[c.alias(n) for n, c in first.items()])
    if tidy is None:
        return out
    return out.withColumns({n: once(F.col(n), lambda c: tidy(c)) for n in wanted if n not in plain})


def _texts_type(paths: Sequence[Sequence[str]]) -> str:
    """Type that reads texts at paths of one length; a path without keys is the value itself."""
    if not paths[0]:
        return "string"
    below: dict[str, list[Sequence[str]]] = {}
    for key, *rest in paths:
        below.setdefault(key, []).append(rest)
    return object_type({key: _texts_type(rests) for key, rests in below.items()})
