"""The master manifest: one row an image in fixed columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from speclake.functions import scalars as S
from speclake.operators.components import components
from speclake.sources.shared import cut, sized

#: The manifest's columns.
COLUMNS = (
    "record_id",
    "source",
    "source_record_id",
    "source_image_id",
    "image_url",
    "local_path",
    "image_sha256",
    "image_license",
    "photo_license",
    "copyright_holder",
    "attribution",
    "publisher",
    "source_dataset",
    "source_url",
    "basis_of_record",
    "is_preserved_specimen",
    "kingdom",
    "phylum",
    "class",
    "order",
    "family",
    "subfamily",
    "tribe",
    "genus",
    "species",
    "subspecies",
    "original_scientific_name",
    "accepted_scientific_name",
    "taxon_id",
    "identification_level",
    "label_quality",
    "identified_by",
    "identification_remarks",
    "country",
    "state_province",
    "latitude",
    "longitude",
    "elevation_m",
    "event_date",
    "sex",
    "life_stage",
    "view_type",
    "parent_specimen_id",
    "view_count",
    "available_views",
    "dna_barcode",
    "dna_bin",
    "observation_id",
    "photo_id",
    "observation_url",
    "observer",
    "specimen_group_id",
    "duplicate_group_id",
    "split_group",
    "source_split",
    "split",
    "eligible_supervised",
    "exclusion_reason",
)


def _or(*columns: str):
    return F.coalesce(*[F.nullif(F.col(c), F.lit("")) for c in columns], F.lit(""))


def settled(df: DataFrame, only: set[str] | None = None) -> DataFrame:
    """``df`` (of its columns ``only`` those), whose columns the optimizer doesn't put into the expressions that come after it: what is used several times is computed once, and generated code stays small enough to compile."""
    kept = [F.col(f"`{c}`") for c in df.columns if only is None or c in only]
    return df.select(F.explode(F.array(F.struct(*kept))).alias("_row")).select("_row.*")


def _filled(df: DataFrame) -> DataFrame:
    """Manifest columns that ``df`` lacks as constants: the optimizer computes what is made of them, so they cost nothing a row."""
    return df.select("*", *[F.lit("").alias(c) for c in COLUMNS if c not in df.columns])


def finalize(df: DataFrame) -> DataFrame:
    """Every manifest column filled: canonical names, ranks from each other, licence, ids, groups, eligibility. Applying it again changes nothing."""
    have = {c.lower(): c for c in df.columns}
    live = have.keys() & set(COLUMNS)
    raw = _filled(settled(df.select(*[S.clean(df[have[c]]).alias(c) for c in COLUMNS if c in live])) if live else df.select())
    ranks = {r: S.canonical_taxon(F.col(r), r) for r in ("order", "family", "genus", "species", "subspecies") if r in live}
    live |= {"source"}
    raw = _filled(settled(raw.withColumns({"source": F.when(F.col("source") == "", "unknown").otherwise(F.col("source"))} | ranks), live))
    raw = raw.withColumn("species", F.when(F.col("species") == "", S.canonical_taxon(F.col("subspecies"))).otherwise(F.col("species")))
    raw = raw.withColumn("genus", F.when(F.col("genus") == "", S.canonical_taxon(F.col("species"), "genus")).otherwise(F.col("genus")))
    basis = F.upper("basis_of_record")
    raw = raw.withColumns({
        "image_license": S.normalize_license(_or("image_license", "photo_license")),
        "basis_of_record": basis,
        "is_preserved_specimen": S.as_bool(F.col("is_preserved_specimen")) | (basis == "PRESERVED_SPECIMEN"),
        "identification_level": F.when(F.col("identification_level") != "", F.col("identification_level")).otherwise(S.taxon_level({r: F.col(r) for r in S.RANKS})),
        "source_record_id": _or("source_record_id", "observation_id"),
        "source_image_id": _or("source_image_id", "photo_id", "image_url", "local_path"),
    })
    live |= {"image_license", "basis_of_record", "is_preserved_specimen", "identification_level", "source_record_id", "source_image_id"} | ({"species", "genus"} if live & {"subspecies", "species"} else set())
    raw = _filled(settled(raw, live))
    group = F.coalesce(
        F.nullif(_or("specimen_group_id", "parent_specimen_id", "split_group"), F.lit("")),
        F.when(F.col("source_record_id") != "", F.concat_ws(":", "source", "source_record_id")),
        S.stable_id(F.col("source"), F.col("source_image_id"), prefix="group"),
    )
    raw = raw.withColumns({"photo_license": F.col("image_license"), "observation_id": _or("observation_id", "source_record_id"), "photo_id": _or("photo_id", "source_image_id"), "specimen_group_id": group})
    raw = _filled(settled(raw, live | {"photo_license", "observation_id", "photo_id", "specimen_group_id"}))
    is_open, stored = F.col("image_license").isin(*S.OPEN_LICENSES), F.col("eligible_supervised")
    labelled = F.col("identification_level").isin("family", "genus", "species", "subspecies")
    raw = raw.withColumns({
        "split_group": _or("duplicate_group_id", "split_group", "specimen_group_id"),
        "record_id": F.when(F.col("record_id") != "", F.col("record_id")).otherwise(S.stable_id(F.col("source"), F.col("source_record_id"), F.col("source_image_id"), prefix="img")),
        "accepted_scientific_name": _or("accepted_scientific_name", "subspecies", "species", "genus", "family"),
        "eligible_supervised": F.when(stored == "", labelled & is_open).otherwise(S.as_bool(stored)),
    })
    reason = F.when(F.col("eligible_supervised") | (F.col("exclusion_reason") != ""), F.col("exclusion_reason")).when(~is_open, F.concat(F.lit("license:"), "image_license"))
    return raw.withColumn("exclusion_reason", reason.when(F.col("identification_level") == "unidentified", "missing_taxonomy").otherwise("")).select(*COLUMNS)


#: Splits, the first of those that a group's rows have officially counts for it.
STRONGEST = ("test", "val", "train")


def build_master(*parts: DataFrame, official_source: str = "", supervised_only: bool = False, train: int = 80, val: int = 10, group_mode: str = "first") -> DataFrame:
    """The union of manifests with splits by group hash; the official hold-outs of one source come first.

    A row's group is the first of its duplicate, split and specimen group; with ``group_mode`` 'component' it is all that specimens
    and duplicate groups link, so that none of them is in two splits: the smallest duplicate group's name, else the
    specimen's, and an official split, the strongest one, holds for the whole of it.
    """
    if group_mode not in ("first", "component"):
        raise ValueError(f"no group mode {group_mode}")
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part, allowMissingColumns=True)
    master = finalize(whole)
    fixed = F.when(F.col("source") == official_source, S.official_split(F.col("source_split")))
    if group_mode == "component":
        master = _in_components(cut(master.withColumn("_fixed", fixed)))
        fixed = F.col("_fixed")
    master = master.withColumn("split", F.coalesce(fixed, S.split_of(F.col("split_group"), train, val))).drop("_fixed")
    return master.filter("eligible_supervised") if supervised_only else master


def _in_components(master: DataFrame) -> DataFrame:
    """``master`` with split_group by components of specimens and duplicate groups, and the official split ``_fixed`` of each."""
    of = lambda kind, column: F.when(F.col(column) != "", F.concat(F.lit(kind), column))
    twin, specimen = of("d:", "duplicate_group_id"), of("s:", "specimen_group_id")
    rows = master.withColumn("_node", F.coalesce(twin, specimen))
    links = rows.filter("_node IS NOT NULL").select(F.col("_node").alias("a"), F.coalesce(specimen, F.col("_node")).alias("b")).distinct()
    roots = cut(components(links)).select(F.col("node").alias("_node"), F.col("root").alias("_root"))
    rooted = rows.join(roots, "_node", "left").withColumn("split_group", F.coalesce(F.substring("_root", 3, 1 << 30), "split_group")).drop("_node")
    place = F.coalesce(*[F.when(F.col("_fixed") == s, F.lit(i)) for i, s in enumerate(STRONGEST)])
    strongest = rooted.filter("_root IS NOT NULL").groupBy("_root").agg(F.min(place).alias("_place")).filter("_place IS NOT NULL")
    held = F.coalesce(F.get(F.array(*map(F.lit, STRONGEST)), F.col("_place")), F.col("_fixed"))
    return rooted.join(strongest, "_root", "left").withColumn("_fixed", held).drop("_root", "_place")


def deduplicate(df: DataFrame, key: str = "duplicate_key", keep_all: bool = False, best: str = "priority") -> DataFrame:
    """The best row of each key with group size; with ``keep_all`` every row. A group's id is set where it has several rows.

    Both ways sum up before the shuffle, so the rows of a hot key never meet in one task.
    """
    size = F.count("*").alias("group_size")
    if keep_all:
        marked = df.join(df.groupBy(F.col(key).alias("_key")).agg(size), F.col(key).eqNullSafe(F.col("_key"))).drop("_key")
    else:
        marked = df.groupBy(F.col(key).alias("_key")).agg(F.min_by(F.struct(*df.columns), F.struct(best, *_sortable(df))).alias("_row"), size).select("_row.*", "group_size")
    return marked.withColumn("duplicate_group_id", F.when(F.col("group_size") > 1, S.stable_id(F.col(key), prefix="dup")).otherwise(""))


def _sortable(df: DataFrame) -> list[str]:
    """The columns that tell equally good rows apart."""
    return [c for c in ("record_id",) if c in df.columns]


def last_per_key(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The row of each key that is first in ``order``."""
    return df.withColumn("_nth", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("_nth = 1").drop("_nth")


def merge(old: DataFrame, new: DataFrame, key: str, keep_ids: bool = False) -> DataFrame:
    """Both manifests by id, the newer row kept. With ``keep_ids`` it is an error if the result lacks an id of the older one."""
    both = old.withColumn("_age", F.lit(1)).unionByName(new.withColumn("_age", F.lit(0)), allowMissingColumns=True)
    merged = last_per_key(both, [key], [F.col("_age")]).drop("_age")
    if keep_ids and not old.filter(F.col(key).isNull() | (F.col(key) == "")).isEmpty():
        raise ValueError(f"rows without {key} would be lost")
    return merged


def synonyms(table: DataFrame) -> DataFrame:
    """(name, accepted): a reviewed table by lower-cased name, which stands in one of three columns. Of a name's rows that which says most, then the last by text, counts."""
    say = lambda *names: S.first_of(table, names)
    name = F.lower(say("original_name", "raw_name", "synonym", "name"))
    accepted = F.struct(say("accepted_name", "accepted_scientific_name").alias("name"), say("accepted_genus").alias("genus"), say("accepted_family").alias("family"), say("accepted_taxon_id").alias("taxon_id"))
    return table.select(name.alias("name"), accepted.alias("accepted")).filter("name != ''").groupBy("name").agg(F.max("accepted").alias("accepted"))


#: Reasons that outlive a change of names.
LASTING = ("missing_image_location", "corrupt_image")


def harmonize(df: DataFrame, reviewed: DataFrame) -> DataFrame:
    """Names replaced by the accepted ones of a reviewed table (``synonyms``): by original name, else by species; then ranks, level and eligibility are set anew.

    A species without a name is read from the original one, a new species brings its genus. Rows without
    an image stay out. The table is broadcast if it is counted to be small, else both lookups shuffle.
    """
    known = sized(synonyms(reviewed))
    rows = df.select(*[(S.clean(df[c]) if c in df.columns else F.lit("")).alias(c) for c in COLUMNS])
    species = S.canonical_taxon(_or("species", "original_scientific_name"))
    rows = rows.withColumns({"_original": F.lower(_or("original_scientific_name", "species")), "species": species})
    for name, key in (("_a", F.col("_original")), ("_b", F.lower("species"))):
        rows = rows.withColumn("_key", key).join(known.select(F.col("name").alias("_key"), F.col("accepted").alias(name)), "_key", "left").drop("_key")
    hit = F.coalesce("_a", "_b")
    said = lambda field, other: F.coalesce(F.nullif(hit[field], F.lit("")), other)
    renamed = F.nullif(S.canonical_taxon(hit["name"]), F.lit(""))
    genus = F.when(renamed.isNotNull(), said("genus", S.canonical_taxon(renamed, "genus"))).otherwise(S.canonical_taxon(F.col("genus"), "genus"))
    rows = rows.withColumns({
        "accepted_scientific_name": said("name", F.col("accepted_scientific_name")),
        "species": F.coalesce(renamed, F.col("species")),
        "genus": genus,
        "family": said("family", S.canonical_taxon(F.col("family"), "family")),
        "taxon_id": said("taxon_id", F.col("taxon_id")),
        "identification_level": F.lit(""),
        "eligible_supervised": F.when(F.col("exclusion_reason").isin(*LASTING), "false").otherwise(""),
    })
    return finalize(rows.drop("_original", "_a", "_b"))
