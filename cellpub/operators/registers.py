"""Registers: base and delta, versions, notices, creations, links between records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellpub.functions.scalars import activity_text, classify_event, classify_procedure, corrected_id, economic_date, fallback_code, first_match, first_of, identifiers, incoherent_date, month_of, strict_date, tolerant_json
from cellpub.operators.joins import lookup


def merge_latest_wins(base: DataFrame, delta: DataFrame, keys: list[str]) -> DataFrame:
    """Delta rows replace base rows of their key, the other base rows stay; columns are matched by name."""
    return delta.unionByName(base.join(delta.select(*keys).distinct(), keys, "left_anti"), allowMissingColumns=True)


def latest_version(versions: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row for each key, the first by ``order``, which should be total."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return versions.withColumn("__rank", rank).where("__rank = 1").drop("__rank")


def unique_mapping(pairs: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Keys that have one value only, and that value."""
    return pairs.groupBy(*keys).agg(F.countDistinct(value).alias("__n"), F.min(value).alias(value)).where("__n = 1").drop("__n")


def any_mapping(pairs: DataFrame, keys: list[str], value: str) -> DataFrame:
    """A value (the smallest) and the number of different values of each key."""
    return pairs.groupBy(*keys).agg(F.min(value).alias(value), F.countDistinct(value).alias("n_values"))


#: Plain fields of a raw notice and what they become.
NOTICE_FIELDS = {
    "id": "id", "publicationavis": "publication", "parution": "issue", "dateparution": "published", "numeroannonce": "number", "typeavis": "notice_type",
    "familleavis": "family", "numerodepartement": "department", "tribunal": "court", "ville": "town", "cp": "postal_code",
}


def flatten_notice(raw: DataFrame) -> DataFrame:
    """Raw notices, some fields of which are JSON text, to 21 columns.

    Beside ``NOTICE_FIELDS`` a notice has ``registre`` (a list of identifiers) and the JSON fields listepersonnes, listeetablissements, jugement, acte and
    parutionavisprecedent. JSON that is missing or malformed counts as empty; where an object may be a list, its first element counts.
    """
    json = {c: tolerant_json(F.col(c)) for c in ("listepersonnes", "listeetablissements", "jugement", "acte", "parutionavisprecedent")}
    field = lambda c, path: F.try_variant_get(json[c], f"$.{path}", "string")
    ids = identifiers(F.col("registre"))
    previous = corrected_id(*[field("parutionavisprecedent", p) for p in ("nomPublication", "numeroParution", "numeroAnnonce")])
    return raw.select(
        *[F.col(c).cast("string").alias(name) if name != "published" else strict_date(F.col(c).cast("string")).alias(name) for c, name in NOTICE_FIELDS.items()],
        F.get(ids, F.lit(0)).alias("company"), F.size(ids).alias("n_companies"), first_of(json["listepersonnes"], "personne.typePersonne").alias("person_type"),
        field("jugement", "famille").alias("judgment_family"), field("jugement", "nature").alias("judgment_nature"), strict_date(field("jugement", "date")).alias("judged"),
        first_of(json["acte"], "vente.categorieVente").alias("sale_category"), first_of(json["acte"], "creation.categorieCreation").alias("creation_category"),
        previous.alias("previous_id"), activity_text(first_of(json["listeetablissements"], "etablissement.activite"), first_of(json["listepersonnes"], "personne.activite")).alias("activity"),
    )


def valid_notices(notices: DataFrame, rules: list[tuple[Column, str]], procedures: list[tuple[str, str]], opening: str, withdrawing: Column) -> DataFrame:
    """Notices of the kinds to count, less those that a cancelling or correcting notice points to, classified and dated.

    ``notices``: id, previous_id, kind, nature, published, judged. Cancelling and correcting notices count as pointers even if they
    are withdrawn themselves; chains are not followed. The anti join is on the id and never broadcast by request.
    """
    withdrawn = notices.where(withdrawing & F.col("previous_id").isNotNull()).select(F.col("previous_id").alias("id")).distinct()
    kept = notices.join(withdrawn, "id", "left_anti").withColumn("event", classify_event(rules))
    return kept.withColumns({
        "procedure": classify_procedure(F.col("event"), F.col("nature"), opening, procedures, "other_procedure"),
        "event_date": economic_date(F.col("judged"), F.col("published")),
        "incoherent_date": incoherent_date(F.col("judged"), F.col("published")),
    })


def creations_units(units: DataFrame, perimeter: DataFrame, links: DataFrame, start: Column, reference: Column) -> DataFrame:
    """Units created in the window inside the perimeter, with takeovers (units that succeed another) and future dates marked.

    ``units``: unit, parent, area, created, code, is_seat.
    """
    takeovers = links.select(F.col("successor").alias("unit")).distinct().withColumn("__taken", F.lit(True))
    inside = units.where(F.col("created") >= start).join(perimeter.select("area"), "area")
    return inside.join(takeovers, "unit", "left").select(
        "unit", "parent", "area", "created", month_of(F.col("created")).alias("month"), "code", "is_seat",
        F.col("__taken").isNotNull().alias("is_takeover"), (F.col("created") > reference).alias("is_future"),
    )


def creations_parents(parents: DataFrame, units: DataFrame, perimeter: DataFrame, links: DataFrame, start: Column, reference: Column) -> DataFrame:
    """New parents whose seat is in the perimeter; a takeover if the seat is. A seat without a link is none.

    ``parents``: parent, seat, created, legal_form.
    """
    takeovers = links.select(F.col("successor").alias("seat")).distinct().withColumn("__taken", F.lit(True))
    seats = units.select(F.col("unit").alias("seat"), "area", "code")
    new = parents.where(F.col("created") >= start).join(seats, "seat").join(perimeter.select("area"), "area").join(takeovers, "seat", "left")
    return new.select(
        "parent", "created", month_of(F.col("created")).alias("month"), "area", "code", (F.col("legal_form") == 1000).alias("is_individual"),
        F.coalesce("__taken", F.lit(False)).alias("is_takeover"), (F.col("created") > reference).alias("is_future"),
    )


def link_records(events: DataFrame, places: DataFrame, seats: DataFrame, parents: DataFrame) -> DataFrame:
    """The area of each event and the method that found it: code and name if one area has both, else the code if it is unique, else the registered seat.

    ``events``: event, code, name, parent. ``places``: area, code, name. ``seats``: parent, area, activity. ``parents``: parent, activity. Added are area, method,
    in_register (the parent is registered, whether or not its seat is known) and activity, the parent's code, else its seat's. Events meet what is known of their
    code once, and what is known of their parent once.
    """
    # One area only: its least is its greatest.
    named = places.where("code is not null").groupBy("code", "name").agg(F.min("area").alias("a"), F.max("area").alias("b"))
    exact = F.collect_list(F.when((F.col("a") == F.col("b")) & F.col("name").isNotNull(), F.struct("name", F.col("a").alias("area"))))
    by_code = named.groupBy("code").agg(F.map_from_entries(exact).alias("__names"), F.when(F.min("a") == F.max("b"), F.min("a")).alias("__unique"))
    null = lambda df, c: F.lit(None).cast(df.schema[c].dataType)
    both = seats.select("parent", F.col("area").alias("__seat"), F.col("activity").alias("__seat_activity"), null(parents, "activity").alias("__own"), F.lit(None).cast("boolean").alias("__registered"))
    both = both.unionByName(parents.select("parent", null(seats, "area").alias("__seat"), null(seats, "activity").alias("__seat_activity"), F.col("activity").alias("__own"), F.lit(True).alias("__registered")))
    register = both.where("parent is not null").groupBy("parent").agg(*[f(c).alias(c) for f, c in ((F.min, "__seat"), (F.min, "__seat_activity"), (F.min, "__own"), (F.max, "__registered"))])
    found = lookup(lookup(events, by_code, ["code"]), register, ["parent"])
    area, method = first_match(("code_and_name", F.try_element_at("__names", F.col("name"))), ("code", F.col("__unique")), ("seat", F.col("__seat")))
    found = found.withColumns({
        "area": area, "method": F.coalesce(method, F.lit("none")), "in_register": F.col("__registered").isNotNull(), "activity": F.coalesce("__own", "__seat_activity"),
    })
    return found.drop("__names", "__unique", "__seat", "__seat_activity", "__own", "__registered")


def localised_events(linked: DataFrame, codes: DataFrame, labels: DataFrame) -> DataFrame:
    """Linked events with their sector and where it comes from: the register's activity, else a label, which is looked up only where the register has none.

    ``codes``: activity, division, section. ``labels``: event, level ('division' or 'section'), label_division, label_section. The section is that of the activity, else the
    label's, else ``ZZ``; the division too, with ``<section>_ND`` for a label of a section. An activity that ``codes`` lacks is ``ZZ``.
    """
    known = lookup(linked, codes.select("activity", F.col("division").alias("__division"), F.col("section").alias("__section")), ["activity"])
    asked = known.withColumn("__ask", F.when(F.col("activity").isNull(), F.col("event")))
    both = lookup(asked, labels.select(F.col("event").alias("__ask"), "level", "label_division", "label_section"), ["__ask"])
    source = F.when(F.col("activity").isNotNull(), "register").when(F.col("level") == "division", "label_division").when(F.col("level") == "section", "label_section").otherwise("none")
    both = both.withColumns({
        "sector_source": source, "division": fallback_code(F.col("__division"), F.col("label_division"), F.col("label_section")), "section": F.coalesce("__section", "label_section", F.lit("ZZ")),
    })
    return both.drop("__ask", "__division", "__section", "level", "label_division", "label_section")
