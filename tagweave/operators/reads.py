"""Read-level tags: moving them out of names, stripping and dropping them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagweave.functions.dna import is_dna
from tagweave.functions.skew import lookup

# How names carry tags.
UNDERLINED = r"_[A-Z]{2}:[AifZHB]:.*(_|$)"
TRAILING_BARCODE = r":[ATGC]{17,}$"
# Tags that alignments hold in columns of their own.
TAG_COLUMNS = ("rx", "mi", "hp", "ps", "pc")


def detect_mode(reads: DataFrame, barcode_tag: str = "bx") -> str:
    """How names carry tags: ``underline`` if any name has underlined ones, else ``trailing`` if any ends in its barcode, else ``none``.

    Decided by one aggregate over all reads.
    """
    seen = reads.agg(
        F.bool_or(F.col("qname").rlike(UNDERLINED)).alias("underline"),
        F.bool_or(F.col("qname").rlike(TRAILING_BARCODE) & F.col(barcode_tag).isNotNull()).alias("trailing"),
    ).first()
    return "underline" if seen["underline"] else "trailing" if seen["trailing"] else "none"


def _name_tags(name: Column) -> Column:
    """(key, kind, value) of the ``_TAG:TYPE:VALUE`` parts of a name, without a ``-n`` suffix; of a tag met twice the last."""

    def parsed(part: Column) -> Column:
        value = F.substring_index(F.substring(part, F.lit(6), F.length(part)), "-", 1)
        wrong = F.raise_error(F.concat(F.lit("tag is not a sequence: "), name))
        return F.struct(
            F.substring(part, 1, 2).alias("key"),
            F.substring(part, 4, 1).alias("kind"),
            F.when(is_dna(value), value).otherwise(wrong).alias("value"),
        )

    parts = F.split(name, "_")
    tagged = F.filter(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))), lambda p: p.rlike("^[A-Z]{2}:[AifZHB]:"))
    found = F.transform(tagged, parsed)
    later = lambda t, i: F.exists(F.slice(found, i + 2, F.size(found)), lambda u: u["key"] == t["key"])
    return F.filter(found, lambda t, i: ~later(t, i))


def tags_from_names(
    reads: DataFrame, mode: str, sample_nr: int = 1, barcode_tag: str = "bx", name_tag: str = "BX"
) -> DataFrame:
    """Move tags from read names to columns; the barcode gets the sample number as suffix.

    Underlined tags: ``name_tag`` goes to ``barcode_tag``, tags with a column to it (``rx`` is added if missing), all others to the map ``tags``
    (tag -> TYPE:value), over those that are there.
    """
    name = F.col("qname")
    if mode == "underline":
        columns = {c: c.upper() for c in TAG_COLUMNS if c == "rx" or c in reads.columns}
        marked = reads.withColumn("_found", _name_tags(name))

        def value_of(tag: str) -> Column:
            return F.try_element_at(F.filter("_found", lambda t: t["key"] == tag), F.lit(1))["value"]

        changed = {barcode_tag: F.concat(value_of(name_tag), F.lit(f"-{sample_nr}"))}
        changed |= {c: value_of(tag) for c, tag in columns.items() if tag != name_tag}
        kinds = dict(reads.dtypes)
        changed = {
            c: F.coalesce(value.cast(kinds[c]), F.col(c)) if c in kinds else value for c, value in changed.items()
        }
        rest = F.filter("_found", lambda t: ~t["key"].isin(name_tag, *columns.values()))
        moved = F.map_from_entries(F.transform(rest, lambda t: F.struct(t["key"], F.concat_ws(":", t["kind"], t["value"]))))
        if "tags" in reads.columns:
            keys = F.map_keys(moved)
            moved = F.map_concat(F.map_filter("tags", lambda k, _: ~F.array_contains(keys, k)), moved)
        return marked.withColumns({**changed, "tags": moved, "qname": F.substring_index("qname", "_", 1)}).drop("_found")
    if mode == "trailing":
        last = F.substring_index(name, ":", -1)
        valid = is_dna(last) & last.startswith(F.substring(F.col(barcode_tag), 1, 16))
        full = F.when(valid, F.concat(last, F.lit(f"-{sample_nr}"))).otherwise(
            F.raise_error(F.concat(F.lit("name does not end in its barcode: "), name))
        )
        tagged = F.col(barcode_tag).isNotNull()
        bare = F.expr("left(qname, length(qname) - length(substring_index(qname, ':', -1)) - 1)")
        return reads.withColumns({
            barcode_tag: F.when(tagged, full),
            "qname": F.when(tagged, bare).otherwise(name),
        })
    return reads


def strip_barcodes(reads: DataFrame, barcodes: DataFrame, barcode_tag: str = "bx", tags: Sequence[str] = ("bx", "mi")) -> DataFrame:
    """Reads of listed barcodes keep their place but lose barcode and molecule; names say so."""
    listed = barcodes.select(barcode_tag).distinct().withColumn("_listed", F.lit(True))
    joined = lookup(reads, listed, barcode_tag)
    hit = F.coalesce("_listed", F.lit(False))
    cleared = {tag: F.when(~hit, F.col(tag)) for tag in tags}
    columns = reads.columns
    return joined.withColumns(
        {"qname": F.when(hit, F.concat("qname", F.lit("_FILTERED"))).otherwise(F.col("qname")), **cleared}
    ).select(*columns)


def stripped_tag_counts(reads: DataFrame, barcodes: DataFrame, barcode_tag: str = "bx", molecule_tag: str = "mi") -> DataFrame:
    """What stripping removes: reads touched and distinct values per tag."""
    hit = reads.join(barcodes.select(barcode_tag).distinct(), barcode_tag, "left_semi")
    return hit.agg(
        F.count(F.lit(1)).alias("reads_with_removed_tags"),
        F.count_distinct(barcode_tag).alias("unique_barcodes"),
        F.count_distinct(molecule_tag).alias("unique_molecules"),
    )


def drop_phasing_tags(reads: DataFrame) -> DataFrame:
    """Remove phase set, haplotype and phasing quality tags."""
    return reads.drop("ps", "hp", "pc")


def coordinate_sorted(reads: DataFrame, contigs: DataFrame | None = None) -> DataFrame:
    """Reads by contig (in index order when ``name, length`` rows with ``nr`` are given) and position.

    The sort is range partitioned on the whole key, so a deep position spreads over tasks.
    """
    if contigs is None:
        return reads.orderBy(F.col("rname").asc_nulls_last(), "start", "end", "qname", "flag")
    ranked = lookup(reads, contigs.select(F.col("name").alias("rname"), F.col("nr").alias("_nr")), "rname")
    return ranked.orderBy(F.col("_nr").asc_nulls_last(), "start", "end", "qname", "flag").drop("_nr")


def unique_program_id(name: str, taken: list[str]) -> str:
    """Identifier of a processing step for a header that already lists ``taken`` ones."""
    candidates = [name, *(f"{name}.{n}" for n in range(1, len(taken) + 1))]
    return next(c for c in candidates if c not in taken)


def tag_or_default(column: str, default=None) -> Column:
    """A tag's value, or the default where it is absent."""
    return F.coalesce(F.col(column), F.lit(default))
