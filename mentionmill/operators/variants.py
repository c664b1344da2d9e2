"""Canonical names of variants and genes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from mentionmill import fixed_values as V


def _map(values: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])


def canonical_gene(c: Column) -> Column:
    """Upper case without separators, aliases resolved."""
    bare = F.regexp_replace(F.upper(F.trim(c)), r"[-_\s]", "")
    return F.coalesce(_map(V.GENE_ALIASES)[bare], bare)


def short_amino_acids(c: Column) -> Column:
    """``Val600Glu`` as ``V600E``: the first such change of the text."""
    codes = "|".join(V.AMINO_ACIDS)
    shape = rf"(?i)\b({codes})(\d+)({codes})\b"
    ref, place, alt = (F.regexp_extract(c, shape, i) for i in (1, 2, 3))
    letter = _map(V.AMINO_ACIDS)
    return F.when(ref != "", F.regexp_replace(c, shape, F.concat(letter[F.lower(ref)], place, letter[F.lower(alt)]))).otherwise(c)


def canonical_variant(c: Column, gene: Column) -> Column:
    c = F.trim(c)
    c = F.when((gene == "TP53") & F.lower(c).startswith("p53"), F.substr(c, F.lit(4))).otherwise(c)
    c = short_amino_acids(c)
    exon = F.lit(None).cast("string")
    for name, marks in V.EXON_NAMES:
        found = F.lit(False)
        for m in marks:
            found = found | F.lower(c).contains(m)
        exon = F.coalesce(exon, F.when(found, F.lit(name)))
    c = F.regexp_replace(F.coalesce(exon, c), r"(?i)^[cp]\.", "")
    return F.lower(F.regexp_replace(c, r"[-_\s.]", ""))


def is_pair(variant: Column, gene: Column) -> Column:
    """Whether a cleaned pair names a variant of a gene at all."""
    bad = F.lit(False)
    for word in V.NOT_IN_VARIANTS:
        bad = bad | variant.contains(word)
    return (
        ~gene.isin(V.NOT_GENES) & ~gene.isin(V.NO_GENE) & F.length(gene).between(2, 10) & F.length(variant).between(2, 40) & (variant != F.lower(gene))
        & ~((variant == "p53") & (gene == "TP53")) & ~variant.isin(V.NOT_VARIANTS) & (variant != "none") & ~bad
    )


def clean_pairs(pairs: DataFrame, key: str, ord_col: str = "ord") -> DataFrame:
    """``key, variant, gene, ord``: cleaned pairs, each once for a key, where it came first."""
    pairs = pairs.withColumn("gene", canonical_gene(F.col("gene"))).withColumn("variant", canonical_variant(F.col("variant"), F.col("gene")))
    return pairs.where(is_pair(F.col("variant"), F.col("gene"))).groupBy(key, "variant", "gene").agg(F.min(ord_col).alias(ord_col))


def without_gene_prefix(variant: Column, gene: Column) -> Column:
    """The variant without its gene's name in front, unless a star or full stop follows."""
    low = F.lower(gene)
    rest = F.substr(variant, F.length(low) + 1)
    return F.when(variant.startswith(low) & ~rest.rlike(r"^[*.]") & (F.length(rest) >= 2), rest).otherwise(variant)


def without_alias_prefix(variant: Column, gene: Column, aliases: dict[str, str]) -> Column:
    """The variant, trimmed and in lower case, without the first alias of its gene that it begins with; else as it is."""
    low, symbol = F.lower(F.trim(variant)), F.upper(F.trim(gene))
    out = F.lit(None).cast("string")
    for alias, canonical in reversed(aliases.items()):
        out = F.when((symbol == canonical) & low.startswith(alias.lower()), F.substr(low, F.lit(len(alias) + 1))).otherwise(out)
    return F.coalesce(out, variant)


def rejected(variant: Column) -> Column:
    shape = F.lit(False)
    for s in V.REJECTED_VARIANT_SHAPES:
        shape = shape | variant.rlike(s)
    return (shape | variant.isin(V.REMOVED_VARIANTS)) & ~variant.isin(V.KEPT_VARIANTS)


def merge_aliases(mentions: DataFrame, aliases: DataFrame) -> DataFrame:
    """``(paper_id, entity)`` with aliases replaced by the canonical name (the first by ``ord``), each pair once."""
    first = aliases.groupBy("alias").agg(F.min_by("canonical", "ord").alias("canonical")).where(F.col("alias") != F.col("canonical"))
    return mentions.join(first, mentions["entity"] == first["alias"], "left").select("paper_id", F.coalesce("canonical", "entity").alias("entity")).distinct()
