"""Ingestors: the exports of several sources as manifest rows, one an image.

Each takes tables of strings (``sources.tables.read_table``) whose columns are found by any of several
names, case aside. Rows out of order, without an id, an image or an open licence are left out as said.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from speclake.functions import documents
from speclake.functions import scalars as S
from speclake.operators import manifest
from speclake.operators.manifest import COLUMNS, settled

#: The order that is kept, its taxon's id in the photo bundle, and where the bundle's photos are.
ORDER, ORDER_TAXON = "Diptera", "47822"
PHOTOS = "https://inaturalist-open-data.s3.amazonaws.com"
IMAGE_WORDS = ("image", "jpeg", "jpg", "png", "webp")
LINEAGE = ("kingdom", "phylum", "class", "order", "family", "subfamily", "tribe", "genus", "species", "subspecies")

#: Manifest columns and the names under which barcode metadata holds them.
BARCODE = {
    "image_url": ("image_url", "image_uri", "url", "identifier"),
    "local_path": ("local_path", "image_path", "image_file", "file_name", "filename"),
    "source_url": ("record_url", "source_url"),
    "kingdom": ("kingdom",),
    "phylum": ("phylum",),
    "class": ("class",),
    "family": ("family",),
    "subfamily": ("subfamily",),
    "genus": ("genus",),
    "identified_by": ("identified_by", "identifier"),
    "country": ("country",),
    "state_province": ("province_state", "province/state", "state_province"),
    "latitude": ("latitude", "coord-lat", "coord_lat"),
    "longitude": ("longitude", "coord-lon", "coord_lon"),
    "event_date": ("event_date", "collection_date"),
    "sex": ("sex",),
    "life_stage": ("life_stage", "stage"),
    "dna_barcode": ("dna_barcode", "nuc", "sequence", "barcode_sequence"),
    "dna_bin": ("dna_bin", "bin", "barcode_index_number"),
    "source_split": ("source_split", "split", "partition"),
}
#: The same for Darwin Core occurrences of specimens,
OCCURRENCE = {
    "family": ("family",),
    "subfamily": ("subfamily",),
    "tribe": ("tribe",),
    "genus": ("genus",),
    "species": ("species", "acceptedscientificname"),
    "subspecies": ("infraspecificepithet", "subspecies"),
    "original_scientific_name": ("scientificname", "verbatimscientificname"),
    "accepted_scientific_name": ("acceptedscientificname",),
    "taxon_id": ("taxonkey", "specieskey", "taxonid"),
    "identified_by": ("identifiedby",),
    "identification_remarks": ("identificationremarks", "taxonremarks"),
    "country": ("country", "countrycode"),
    "state_province": ("stateprovince",),
    "latitude": ("decimallatitude",),
    "longitude": ("decimallongitude",),
    "elevation_m": ("elevation", "minimumelevationinmeters"),
    "event_date": ("eventdate", "dateidentified"),
    "sex": ("sex",),
    "life_stage": ("lifestage",),
    "publisher": ("publishingorgkey", "institutioncode", "ownerinstitutioncode"),
    "source_dataset": ("datasettitle", "datasetname", "datasetkey"),
    "source_url": ("references", "occurrenceid"),
    "image_url": ("media", "identifier", "image_url"),
    "image_license": ("license", "media_license"),
}
#: for flat observations,
OBSERVATION = {
    "family": ("family", "taxon_family"),
    "subfamily": ("subfamily", "taxon_subfamily"),
    "tribe": ("tribe", "taxon_tribe"),
    "subspecies": ("subspecies", "infraspecificepithet"),
    "original_scientific_name": ("scientificname", "scientific_name", "taxon_name"),
    "taxon_id": ("taxon_id", "taxonid", "taxonkey"),
    "identified_by": ("identified_by", "identifiedby"),
    "country": ("country", "countrycode"),
    "state_province": ("stateprovince", "state_province", "place_guess"),
    "latitude": ("decimallatitude", "latitude", "lat"),
    "longitude": ("decimallongitude", "longitude", "lon", "lng"),
    "elevation_m": ("verbatimelevation", "elevation", "elevation_m"),
    "event_date": ("eventdate", "observed_on", "observation_date"),
    "sex": ("sex",),
    "life_stage": ("lifestage", "life_stage"),
    "observer": ("recordedby", "observer", "user_login", "user_name"),
    "source_url": ("references", "uri", "observation_url"),
}
#: and for the parts of digital specimens.
SPECIMEN = {
    "family": ("family",),
    "subfamily": ("subfamily",),
    "tribe": ("tribe",),
    "genus": ("genus",),
    "species": ("species",),
    "subspecies": ("subspecies", "infraspecificEpithet"),
    "original_scientific_name": ("scientificName", "verbatimIdentification"),
    "taxon_id": ("taxonID",),
    "identified_by": ("identifiedBy",),
    "country": ("country",),
    "state_province": ("stateProvince",),
    "latitude": ("decimalLatitude", "latitude"),
    "longitude": ("decimalLongitude", "longitude"),
    "event_date": ("eventDate",),
    "sex": ("sex",),
    "life_stage": ("lifeStage",),
    "publisher": ("publisher", "institutionCode"),
    "source_dataset": ("datasetName", "sourceSystemName"),
    "source_url": ("sourceURL", "landingPage", "doi"),
}


def finalize(rows: DataFrame) -> DataFrame:
    """``manifest.finalize`` of rows whose columns are computed first."""
    return manifest.finalize(settled(rows))


def _named(df: DataFrame, names: tuple[str, ...], default: str = "") -> Column:
    return S.first_of(df, names, default)


def _all_named(df: DataFrame, table: dict[str, tuple[str, ...]], always: tuple[str, ...] = ()) -> dict[str, Column]:
    """The columns of ``table`` that ``df`` has under any name, and ``always``; the others are left to ``finalize``, so that no step carries them."""
    have = {c.lower() for c in df.columns}
    return {target: _named(df, names) for target, names in table.items() if target in always or any(n.lower() in have for n in names)}


def is_image(kind: Column) -> Column:
    """No media type, or one of an image."""
    return (kind == "") | F.lower(kind).rlike("|".join(IMAGE_WORDS))


def is_link(url: Column) -> Column:
    return url.rlike("^https?://")


def opened(rows: DataFrame, licenses: tuple[str, ...] | None) -> DataFrame:
    """The rows with one of ``licenses``; all for None."""
    return rows if licenses is None else rows.filter(F.col("image_license").isin(*licenses))


def _once(df: DataFrame, key: str) -> DataFrame:
    """One row a key, the largest: repeated rows of a source differ in nothing that tells the later one."""
    return df.groupBy(key).agg(F.max(F.struct(*[c for c in df.columns if c != key])).alias("_row")).select(key, "_row.*")


def ingest_barcode(metadata: DataFrame, image_root: str = "", extension: str = ".jpg", any_order: bool = False) -> DataFrame:
    """Barcoded specimens; a row without any image stays, but isn't eligible."""
    order, process = _named(metadata, ("order", "taxon_order")), _named(metadata, ("processid", "process_id", "sampleid", "sample_id", "specimen_id"))
    said = _all_named(metadata, BARCODE, ("local_path", "dna_barcode"))
    raw = _named(metadata, ("species", "species_name"))
    species = S.real_species(raw)
    path = said["local_path"]
    if image_root:
        path = F.concat(F.lit(image_root.rstrip("/") + "/"), F.coalesce(F.nullif(path, F.lit("")), F.concat(process, F.lit(extension))))
    fixed = {
        "source": F.lit("BIOSCAN-5M"), "source_record_id": process, "source_image_id": process, "local_path": path, "image_license": _named(metadata, ("license", "image_license"), "CC BY 3.0"),
        "copyright_holder": _named(metadata, ("copyright_holder",), "CBG Photography Group"), "attribution": _named(metadata, ("attribution", "photographer"), "CBG Robotic Imager"),
        "publisher": _named(metadata, ("publisher",), "Centre for Biodiversity Genomics"), "source_dataset": F.lit("BIOSCAN-5M"), "basis_of_record": F.lit("PRESERVED_SPECIMEN"), "is_preserved_specimen": F.lit("true"),
        "order": F.coalesce(F.nullif(order, F.lit("")), F.lit(ORDER)), "species": species, "original_scientific_name": F.coalesce(F.nullif(raw, F.lit("")), _named(metadata, ("taxon",))),
        "specimen_group_id": F.concat(F.lit("BIOSCAN-5M:"), process), "label_quality": S.barcode_quality(said["dna_barcode"], species),
    }
    wanted = metadata.filter(process != "") if any_order else metadata.filter((process != "") & (F.lower(order) == ORDER.lower()))
    rows = finalize(wanted.select(*[c.alias(k) for k, c in (said | fixed).items()]))
    bare = (F.col("image_url") == "") & (F.col("local_path") == "")
    return rows.withColumns({"eligible_supervised": F.col("eligible_supervised") & ~bare, "exclusion_reason": F.when(bare, "missing_image_location").otherwise(F.col("exclusion_reason"))})


def occurrences(df: DataFrame, any_order: bool = False, more: tuple[str, ...] = ()) -> DataFrame:
    """(_join, manifest columns, ``more``) of Darwin Core occurrences of preserved specimens, not finalized."""
    order, basis, join = _named(df, ("order",)), F.upper(_named(df, ("basisofrecord", "basis_of_record"))), _named(df, ("gbifid", "id", "occurrenceid", "coreid"))
    said = _all_named(df, OCCURRENCE, ("image_url", "species"))
    fixed = {
        "source": F.lit("GBIF"), "source_record_id": join, "order": F.coalesce(F.nullif(order, F.lit("")), F.lit(ORDER)), "basis_of_record": F.coalesce(F.nullif(basis, F.lit("")), F.lit("PRESERVED_SPECIMEN")),
        "is_preserved_specimen": F.lit("true"), "specimen_group_id": F.concat(F.lit("GBIF:"), join), "label_quality": S.determined_quality(said["species"]),
    }
    wanted = df.filter(join != "") if any_order else df.filter((join != "") & (F.lower(order) == ORDER.lower()) & (basis == "PRESERVED_SPECIMEN"))
    return wanted.select(join.alias("_join"), *[c.alias(k) for k, c in (said | fixed).items()], *more)


def ingest_dwca(occurrence: DataFrame, multimedia: DataFrame | None = None, licenses: tuple[str, ...] | None = S.OPEN_LICENSES, any_order: bool = False) -> DataFrame:
    """Specimens of a Darwin Core archive: with a table of media, one row an image of it; without, the rows that hold their own image."""
    base = _once(occurrences(occurrence, any_order), "_join")
    if multimedia is None:
        return opened(finalize(base.filter("image_url != ''").drop("_join")), licenses)
    url = _named(multimedia, ("identifier", "accessuri", "references", "image_url", "url"))
    media = multimedia.filter(is_image(_named(multimedia, ("type", "mediatype", "format"))) & is_link(url)).select(
        _named(multimedia, ("coreid", "gbifid", "occurrenceid", "parentid")).alias("_join"), F.coalesce(F.nullif(_named(multimedia, ("id", "identifier", "mediaid")), F.lit("")), url).alias("source_image_id"), url.alias("image_url"),
        _named(multimedia, ("license", "licence", "rights", "rightsuri")).alias("image_license"), _named(multimedia, ("rightsholder", "creator", "owner")).alias("copyright_holder"), _named(multimedia, ("creator", "title", "description")).alias("attribution"))
    return opened(finalize(base.drop("image_url", "image_license").join(media, "_join").drop("_join")), licenses)


def _photos(rows: DataFrame, size: str) -> DataFrame:
    """(image columns) of photo rows that are images with a link, their own or that of the photo bundle."""
    photo = _named(rows, ("photo_id", "id", "mediaid"))
    own = _named(rows, ("image_url", "photo_url", "accessuri", "contenturl", "identifier", "url"))
    url = F.when((own == "") & (photo != ""), S.media_url(PHOTOS, photo, F.regexp_replace(_named(rows, ("extension",), "jpg"), r"^\.+", ""), size)).otherwise(own)
    named = rows.withColumns({
        "_image": F.struct(
            F.coalesce(F.nullif(photo, F.lit("")), F.nullif(_named(rows, ("identifier",)), F.lit("")), url).alias("source_image_id"), photo.alias("photo_id"), url.alias("image_url"), _named(rows, ("license", "licence", "rights", "rightsuri")).alias("image_license"),
            _named(rows, ("rightsHolder", "creator", "owner")).alias("copyright_holder"), _named(rows, ("attribution", "creator", "title")).alias("attribution")),
    })
    return named.filter(is_image(_named(rows, ("type", "mediatype", "format", "dc:type"))) & is_link(url))


def _credited(rows: DataFrame, licenses: tuple[str, ...] | None) -> DataFrame:
    """Holder and attribution default to the observer."""
    credit = lambda c: F.coalesce(F.nullif(F.col(c), F.lit("")), "observer").alias(c)
    return opened(finalize(rows.withColumns({c: credit(c) for c in ("copyright_holder", "attribution")})), licenses)


def ingest_flat_occurrences(observations: DataFrame, photos: DataFrame | None = None, licenses: tuple[str, ...] | None = S.OPEN_LICENSES, any_order: bool = False, size: str = "medium") -> DataFrame:
    """Observations of a flat export, with a table of photos or with one image each."""
    order, join = _named(observations, ("order", "taxon_order", "dwc:order")), _named(observations, ("id", "observation_id", "gbifid", "occurrenceid", "coreid", "uuid"))
    said = _all_named(observations, OBSERVATION, ("original_scientific_name", "observer"))
    rank = F.lower(_named(observations, ("taxonrank", "taxon_rank", "rank")))
    species = _named(observations, ("species", "taxon_species"))
    species = F.when((species == "") & rank.isin("species", "subspecies", "variety"), S.canonical_taxon(said["original_scientific_name"])).otherwise(species)
    genus = F.coalesce(F.nullif(_named(observations, ("genus", "taxon_genus")), F.lit("")), S.canonical_taxon(species, "genus"))
    fixed = {
        "source": F.lit("iNaturalist"), "source_record_id": join, "observation_id": join, "order": F.coalesce(F.nullif(order, F.lit("")), F.lit(ORDER)), "genus": genus, "species": species,
        "source_dataset": _named(observations, ("datasetname", "dataset_name"), "iNaturalist bulk export"), "basis_of_record": _named(observations, ("basisofrecord", "basis_of_record"), "HUMAN_OBSERVATION"), "label_quality": S.determined_quality(species, F.lit(True), specimen=False),
    }
    wanted = observations.filter(join != "") if any_order else observations.filter((join != "") & (F.lower(order) == ORDER.lower()))
    about = wanted.select(join.alias("_join"), *[c.alias(k) for k, c in (said | fixed).items()], *([] if photos is not None else [
        _named(observations, ("image_url", "photo_url", "identifier", "media")).alias("url"), _named(observations, ("photo_license", "media_license", "license", "rights")).alias("license"), _named(observations, ("photo_id", "media_id")).alias("photo_id")]))
    base = _once(about, "_join")
    if photos is None:
        images = _photos(base, size).drop("url", "license", "photo_id")
        return _credited(images.select("*", "_image.*").drop("_image", "_join"), licenses)
    images = _photos(photos, size).select(_named(photos, ("observation_uuid", "coreid", "observation_id", "occurrenceid", "gbifid", "parentid")).alias("_join"), "_image.*")
    return _credited(base.join(images, "_join").drop("_join"), licenses)


def lineages(taxa: DataFrame, root: str = ORDER_TAXON) -> DataFrame:
    """(taxon_id, names by rank) of ``root`` and the taxa below it: ids of the ancestry from the top, the taxon itself last; of a rank the last name counts."""
    t = _once(taxa.select(_named(taxa, ("taxon_id", "id")).alias("taxon_id"), S.ancestry_ids(_named(taxa, ("ancestry", "ancestor_ids"))).alias("path"), F.lower(_named(taxa, ("rank",))).alias("rank"), _named(taxa, ("name", "scientific_name")).alias("name")).filter("taxon_id != ''"), "taxon_id")
    clade = t.filter((F.col("taxon_id") == root) | F.array_contains("path", root)).select("taxon_id", F.concat("path", F.array("taxon_id")).alias("path"))
    steps = clade.select("taxon_id", F.posexplode("path").alias("at", "id"))
    named = steps.join(t.select(F.col("taxon_id").alias("id"), "rank", "name").filter("name != ''"), "id")
    last = [F.coalesce(F.max_by("name", F.when(F.col("rank") == r, F.col("at"))), F.lit("")).alias(r) for r in LINEAGE]
    return clade.select("taxon_id").join(named.groupBy("taxon_id").agg(*last), "taxon_id", "left").na.fill("")


def ingest_photo_bundle(observations: DataFrame, photos: DataFrame, taxa: DataFrame, observers: DataFrame | None = None, grades: tuple[str, ...] = ("research",), licenses: tuple[str, ...] | None = S.OPEN_LICENSES, size: str = "medium", root: str = ORDER_TAXON) -> DataFrame:
    """Photos of observations of one clade from a bundle of four tables."""
    from speclake.operators.records import grade_in

    ranks = lineages(taxa, root)
    if ranks.filter(F.col("taxon_id") == root).isEmpty():
        raise ValueError(f"no taxon {root}")
    grade, uuid = _named(observations, ("quality_grade",)), _named(observations, ("observation_uuid", "uuid", "id"))
    rows = observations.filter((uuid != "") & grade_in(grade, list(grades))).select(
        uuid.alias("_join"), _named(observations, ("taxon_id",)).alias("taxon_id"), (F.lower(F.replace(grade, F.lit("_"), F.lit(" "))) == "research").alias("_agreed"), _named(observations, ("latitude", "lat")).alias("latitude"),
        _named(observations, ("longitude", "lon", "lng")).alias("longitude"), _named(observations, ("observed_on", "event_date")).alias("event_date"), _named(observations, ("observer_id",)).alias("observer"))
    known = _once(rows, "_join").join(ranks, "taxon_id")
    species = S.canonical_taxon(F.col("species"))
    base = known.withColumns({
        "source": F.lit("iNaturalist"), "source_record_id": F.col("_join"), "observation_id": F.col("_join"), "source_url": F.concat(F.lit("https://www.inaturalist.org/observations/"), "_join"),
        "source_dataset": F.lit("iNaturalist Licensed Observation Images"), "basis_of_record": F.lit("HUMAN_OBSERVATION"), "order": F.coalesce(F.nullif(F.col("order"), F.lit("")), F.lit(ORDER)),
        "original_scientific_name": F.coalesce(F.nullif(F.col("subspecies"), F.lit("")), F.nullif(species, F.lit("")), "genus"), "species": species, "label_quality": S.determined_quality(species, F.col("_agreed"), specimen=False),
    }).drop("_agreed")
    images = _photos(photos, size).select(_named(photos, ("observation_uuid", "coreid", "observation_id", "occurrenceid", "gbifid", "parentid")).alias("_join"), _named(photos, ("observer_id",)).alias("_observer"), "_image.*")
    if observers is not None:
        who = observers.select(_named(observers, ("observer_id", "id")).alias("_observer"), _named(observers, ("login", "name")).alias("_login"))
        images = images.join(_once(who.filter("_observer != ''"), "_observer"), "_observer", "left")
    joined = base.join(images, "_join")
    if observers is not None:
        joined = joined.withColumn("observer", F.coalesce(F.nullif(F.col("_login"), F.lit("")), "observer")).drop("_login")
    return _credited(joined.drop("_join", "_observer"), licenses)


def full_response(document: Column) -> Column:
    """A digital specimen's JSON text: of a full response the specimen with its media objects, annotations left out; other documents as they are."""
    held = F.get_json_object(document, "$.data.attributes.digitalSpecimen")
    identity = F.to_json(F.struct(F.coalesce(F.get_json_object(document, "$.data.id"), F.lit("")).alias("id")))
    objects = F.transform(F.coalesce(F.from_json(F.get_json_object(document, "$.data.attributes.digitalMedia"), "array<string>"), F.array().cast("array<string>")), lambda m: F.coalesce(F.get_json_object(m, "$.digitalMediaObject"), m))
    inner = lambda text: F.nullif(F.regexp_replace(text, r"^\s*\{\s*|\s*\}\s*$", ""), F.lit(""))
    source = F.replace(inner(identity), F.lit('"id":'), F.lit('"source_url":'))
    whole = F.concat(F.lit("{"), F.concat_ws(",", inner(identity), source, inner(held), F.concat(F.lit('"digitalMedia":['), F.array_join(objects, ","), F.lit("]"))), F.lit("}"))
    return F.when(held.startswith("{"), whole).otherwise(document)


def ingest_digital_specimens(docs: DataFrame, document: str = "document", licenses: tuple[str, ...] | None = S.OPEN_LICENSES, any_order: bool = False) -> DataFrame:
    """Specimens from nested JSON (``document``, a text a specimen) with a row for each of their images; fields are searched at any depth, annotations never read."""
    tree = docs.select(documents.opened(full_response(F.col(document))).alias("tree")).filter(F.size("tree") > 0)
    tree = settled(tree.withColumns({"_all": documents.leaves(F.col("tree")), "_near": documents.nearest(F.col("tree"))}))
    top = lambda *names: F.nullif(documents.first_of(F.col("_near"), *names), F.lit(""))
    any_ = lambda *names: F.nullif(documents.pick(F.col("_all"), *names), F.lit(""))
    first = lambda names: F.coalesce(top(*names), any_(*names), F.lit(""))
    order, basis = first(("order",)), F.coalesce(any_("basisOfRecord"), F.lit(""))
    identity = F.coalesce(top("id", "digital_specimen_id", "specimen_id", "doi"), any_("digitalSpecimenId", "physicalSpecimenId", "catalogNumber", "occurrenceID", "doi"), F.lit(""))
    said = {k: first(v) for k, v in SPECIMEN.items()}
    said["source_url"] = F.coalesce(top("source_url", "references"), said["source_url"])
    base = tree.withColumns({"_order": order, "source_record_id": identity, "_basis": F.lower(F.replace(basis, F.lit("_"), F.lit("")))} | said)
    base = settled(base.drop("_all", "_near"))
    kept = (F.col("source_record_id") != "") & F.col("_basis").isin("", "preservedspecimen")
    base = base.filter(kept if any_order else kept & (F.lower("_order") == ORDER.lower()))
    places = documents.media(F.col("tree"))
    each = base.withColumn("_at", F.explode(F.when(F.size(places) > 0, places).otherwise(F.array(F.lit(0))))).withColumn("item", documents.below(F.col("tree"), F.col("_at"))).drop("tree", "_at")
    each = settled(each.withColumns({"_all": documents.leaves(F.col("item")), "_near": documents.nearest(F.col("item"))}).drop("item"))
    at, deep = top, any_
    url = F.coalesce(at("accessuri", "contenturl", "image_url", "url"), deep("accessURI"), deep("contentUrl"), deep("downloadURL"), at("identifier"), deep("identifier"), F.lit(""))
    kind = F.coalesce(at("type", "mediatype", "format"), deep("type", "mediaType", "format"), F.lit(""))
    rows = each.filter(is_image(kind) & is_link(url) & ~url.rlike(r"^https?://(dx\.)?doi\.org/")).withColumns({
        "source": F.lit("DiSSCo"), "basis_of_record": F.lit("PRESERVED_SPECIMEN"), "is_preserved_specimen": F.lit("true"), "order": F.coalesce(F.nullif(F.col("_order"), F.lit("")), F.lit(ORDER)),
        "specimen_group_id": F.concat(F.lit("DiSSCo:"), "source_record_id"), "label_quality": S.determined_quality(F.col("species")), "image_url": url,
        "source_image_id": F.coalesce(at("media_id", "id", "@id"), deep("digitalMediaId", "mediaID"), url), "image_license": F.coalesce(at("license", "licence", "rights"), deep("license", "rights", "rightsURI"), F.lit("")),
        "copyright_holder": F.coalesce(at("rightsholder", "copyright_holder"), deep("rightsHolder", "creator"), F.lit("")), "attribution": F.coalesce(at("attribution", "creator", "title"), deep("creator", "title"), F.lit("")),
    })
    return opened(finalize(rows.drop("_all", "_near", "_order", "_basis")), licenses)


#: The fields of an occurrence in the response of a search that are read by name; the media are read with it.
API_MEDIA = "media array<struct<type:string,identifier:string,license:string,rightsHolder:string,creator:string>>"
API_FIELDS = ("key", "order", "family", "genus", "species", "scientificName", "acceptedScientificName", "taxonKey", "basisOfRecord", "datasetKey", "datasetName", "occurrenceID", "references", "country", "stateProvince", "decimalLatitude", "decimalLongitude", "elevation", "eventDate", "sex", "lifeStage", "institutionCode", "identifiedBy", "recordedBy")


def ingest_api_pages(pages: DataFrame, family: str, response: str = "response", dataset: str | None = None) -> DataFrame:
    """Occurrences of one family from landed pages of search responses (JSON text with ``results``): at most one row each, with the first image of an open licence.

    With ``dataset``, observations of that dataset, which need an observation's page; else preserved specimens.
    """
    from speclake.sources.tables import unwrap

    schema = ", ".join([f"`{c}` string" for c in API_FIELDS] + [API_MEDIA])
    items = pages.select(F.explode(unwrap(F.col(response))).alias("item")).select(F.from_json("item", schema).alias("x")).select("x.*")
    wanted = items.filter((F.col("order") == ORDER) & (F.lower("family") == family.lower()))
    wanted = wanted.filter(F.col("datasetKey") == dataset) if dataset else wanted.filter("basisOfRecord = 'PRESERVED_SPECIMEN'")
    fits = lambda m: S.normalize_license(m["license"]).isin(*S.OPEN_LICENSES) & is_link(F.coalesce(m["identifier"], F.lit(""))) & (F.coalesce(m["type"], F.lit("StillImage")) == "StillImage")
    shown = wanted.withColumn("_media", F.get(F.filter("media", fits), 0)).filter("_media IS NOT NULL").drop("media")
    base = occurrences(shown.withColumnRenamed("key", "gbifID"), True, ("_media", "recordedBy", "datasetName", "datasetKey", "occurrenceID", "references"))
    named = base.withColumns({
        "image_url": F.col("_media.identifier"), "image_license": F.col("_media.license"), "source_image_id": F.col("_media.identifier"), "copyright_holder": F.coalesce("_media.rightsHolder", F.lit("")),
        "attribution": F.coalesce(F.nullif(F.col("_media.creator"), F.lit("")), "recordedBy", F.lit("")), "source_dataset": F.concat(F.coalesce("datasetName", F.lit("")), F.lit(" [GBIF dataset "), F.coalesce("datasetKey", F.lit("")), F.lit("]")),
    })
    if dataset:
        page = F.coalesce(F.nullif(F.col("occurrenceID"), F.lit("")), "references", F.lit(""))
        number, photo = S.observation_id(page), S.photo_id(F.col("image_url"))
        named = named.filter(number.isNotNull()).withColumns({
            "source": F.lit("iNaturalist"), "source_record_id": number, "observation_id": number, "source_url": page, "specimen_group_id": F.concat(F.lit("iNaturalist:"), number), "basis_of_record": F.lit("HUMAN_OBSERVATION"), "is_preserved_specimen": F.lit("false"),
            "label_quality": S.determined_quality(F.col("species"), F.lit(True), specimen=False), "source_dataset": F.lit(f"iNaturalist Research-grade Observations via GBIF:{dataset}"),
            "source_image_id": F.coalesce(photo, "source_image_id"), "image_url": F.when(photo.isNotNull(), F.regexp_replace("image_url", r"/original\.", "/medium.")).otherwise(F.col("image_url")),
        })
    return finalize(named.select(*[c for c in COLUMNS if c in named.columns]))


def ingest_local_views(listing: DataFrame, family: str, genus: str = "", species: str = "", collector: str = "", voucher: str = "", prefix: str = "LOCAL", view: str = "auto") -> DataFrame:
    """One's own images (local_path): all of one ``voucher``, or each with a voucher numbered by path."""
    name = F.regexp_extract("local_path", "([^/]*)$", 1)
    rows = listing.withColumn("_voucher", F.lit(voucher)) if voucher else _numbered(listing).withColumn("_voucher", F.format_string(f"{prefix}-%05d", "_nth"))
    return finalize(rows.select(
        F.lit("local_verified").alias("source"), F.col("_voucher").alias("source_record_id"), name.alias("source_image_id"), F.col("local_path"), F.lit("PRESERVED_SPECIMEN").alias("basis_of_record"), F.lit("true").alias("is_preserved_specimen"),
        F.lit(ORDER).alias("order"), F.lit(family).alias("family"), F.lit(genus).alias("genus"), F.lit(species).alias("species"), F.lit(collector).alias("observer"), F.lit("project-owned").alias("image_license"), F.lit(collector).alias("attribution"),
        (S.view_type(name) if view == "auto" else F.lit(view)).alias("view_type"), F.col("_voucher").alias("parent_specimen_id"), F.concat(F.lit("local:"), "_voucher").alias("specimen_group_id"), F.lit("A").alias("label_quality")))


def _numbered(listing: DataFrame) -> DataFrame:
    """``listing`` with _nth, its place by path from 1: places within ranges of paths plus the rows of the ranges before, so no task holds all."""
    from pyspark.sql import Window

    from speclake.sources.shared import cut

    ranged = cut(listing.repartitionByRange("local_path").withColumn("_part", F.spark_partition_id()))
    sizes = ranged.groupBy("_part").agg(F.count("*").alias("_n"))
    before = sizes.select("_part", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))  # a row a partition
    nth = F.row_number().over(Window.partitionBy("_part").orderBy("local_path"))
    return ranged.withColumn("_nth", nth).join(F.broadcast(before), "_part").withColumn("_nth", F.col("_nth") + F.col("_before")).drop("_part", "_before")
