"""Seeds of films: the catalogue's films, their aliases and milestones, and the queries by which they are listened for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from buzzmill.functions.text import fold
from buzzmill.functions.times import milestones
from buzzmill.operators.tables import replace_keys

# Labels and colours of a film's milestones by kind.
MILESTONE_LABELS = {"announcement": "Công bố dự án", "trailer": "Trailer Drop", "press_sneak": "Press Tour / Sneak Show", "premiere": "Premiere / Opening Weekend", "w1_decay": "W1 → W2 Decay"}
MILESTONE_COLORS = {"announcement": "#60A5FA", "trailer": "#F59E0B", "press_sneak": "#8B5CF6", "premiere": "#EF4444", "w1_decay": "#64748B"}
FILM_PLATFORMS = ("facebook", "tiktok", "threads", "google_maps", "instagram", "youtube")
SHORTEST_ALIAS = 3


def _text(c: str) -> Column:
    return F.trim(F.coalesce(F.col(c), F.lit("")))


def listed(catalog: DataFrame) -> DataFrame:
    """Films of a catalogue (pos, slug, title, short_title, status, active, release_date, trailer_date, press_date, distributor, compare_group, aliases) that have a slug and a title.

    Of entries with the same slug the last one counts; a film is upcoming and active unless it says otherwise.
    """
    rows = catalog.withColumn("slug", _text("slug")).withColumn("title", _text("title")).where("slug <> '' and title <> ''")
    rest = [c for c in rows.columns if c != "slug"]
    last = rows.groupBy("slug").agg(F.max_by(F.struct(*rest), "pos").alias("f")).select("slug", "f.*")
    return last.withColumn("status", F.coalesce(F.nullif("status", F.lit("")), F.lit("upcoming"))).withColumn("active", F.coalesce("active", F.lit(True)))


def seed_films(old: DataFrame, catalog: DataFrame) -> DataFrame:
    """films (film_slug, film_title, short_title, status, is_active, release_date, trailer_date, distributor, compare_group) after a catalogue: its films as they are there, others as they were."""
    new = listed(catalog).select(F.col("slug").alias("film_slug"), F.col("title").alias("film_title"), "short_title", "status", F.col("active").alias("is_active"), "release_date", "trailer_date", "distributor", "compare_group")
    return replace_keys(old.select(*new.columns), new, ["film_slug"])


def seed_aliases(old: DataFrame, catalog: DataFrame) -> DataFrame:
    """aliases (alias_norm, alias, film_slug) after a catalogue: titles, short titles and aliases by their folded form.

    Forms of fewer than three characters are none. Of equal forms the last of the catalogue counts, also over older ones.
    """
    names = F.concat(F.array("title", "short_title"), F.coalesce("aliases", F.array().cast("array<string>")))
    each = catalog.where((_text("slug") != "") & (_text("title") != "")).select(F.trim("slug").alias("film_slug"), "pos", F.posexplode(names).alias("n", "alias"))
    each = each.withColumn("alias", F.trim("alias")).withColumn("alias_norm", fold(F.coalesce("alias", F.lit("")))).where(F.char_length("alias_norm") >= SHORTEST_ALIAS)
    new = each.groupBy("alias_norm").agg(F.max_by(F.struct("alias", "film_slug"), F.struct("pos", "n")).alias("a")).select("alias_norm", "a.*")
    return replace_keys(old.select(*new.columns), new, ["alias_norm"])


def seed_milestones(old: DataFrame, catalog: DataFrame, overrides: DataFrame) -> DataFrame:
    """milestones (film_slug, kind, label, day, color, sort_order) after a catalogue: those of its active films are made anew.

    A film with overrides (film_slug, pos, kind, label, day, color) has these alone, in their order; those without a label or day are
    left out but keep their number. Other films have five made from the release; without a release they have none.
    """
    films = listed(catalog).where("active")
    own = overrides.withColumn("film_slug", _text("film_slug")).where("film_slug <> ''").groupBy("film_slug").agg(F.array_sort(F.collect_list(F.struct("pos", F.coalesce("kind", F.lit("custom")).alias("kind"), _text("label").alias("label"), "day", "color"))).alias("own"))
    text = lambda pairs, k: F.element_at(F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv]), k)
    made = F.transform(milestones(F.col("release_date"), F.col("trailer_date"), F.col("press_date")), lambda m: F.struct(m["kind"].alias("kind"), text(MILESTONE_LABELS, m["kind"]).alias("label"), m["day"].alias("day"), text(MILESTONE_COLORS, m["kind"]).alias("color")))
    given = F.transform("own", lambda m: F.struct(m["kind"].alias("kind"), m["label"].alias("label"), m["day"].alias("day"), m["color"].alias("color")))
    rows = films.join(own, films["slug"] == own["film_slug"], "left").select(F.col("slug").alias("film_slug"), F.posexplode(F.when(F.col("own").isNotNull(), given).otherwise(made)).alias("sort_order", "m"))
    new = rows.select("film_slug", "m.kind", "m.label", F.col("m.day").cast("date").alias("day"), "m.color", "sort_order").where("label <> '' and day is not null")
    untouched = old.select(*new.columns).join(films.select(F.col("slug").alias("film_slug")), "film_slug", "left_anti")
    return untouched.unionByName(new)


def seed_movie_queries(old: DataFrame, catalog: DataFrame, payloads: DataFrame, force: bool = False) -> DataFrame:
    """queries (film_slug, query_name, keywords, hashtags, platforms, is_active) after a catalogue with payloads (slug, keywords, hashtags).

    A film without keywords is listened for by its title. Known queries stay as they are unless forced; terms are trimmed, each once.
    """
    terms = lambda c: F.array_distinct(F.filter(F.transform(F.coalesce(c, F.array().cast("array<string>")), lambda x: F.trim(x)), lambda x: x.isNotNull() & (x != "")))
    rows = listed(catalog).join(payloads.select("slug", "keywords", "hashtags"), "slug", "left")
    keywords = F.when(F.size(terms(F.col("keywords"))) > 0, terms(F.col("keywords"))).otherwise(F.array("title"))
    new = rows.select(F.col("slug").alias("film_slug"), F.col("title").alias("query_name"), keywords.alias("keywords"), terms(F.col("hashtags")).alias("hashtags"), F.array(*map(F.lit, FILM_PLATFORMS)).alias("platforms"), F.col("active").alias("is_active"))
    old = old.select(*new.columns)
    return replace_keys(old, new, ["film_slug"]) if force else replace_keys(new, old, ["film_slug"])


def seed_alert_rules(old: DataFrame, rules: DataFrame) -> DataFrame:
    """Alert rules by name: those of the seed that are not there yet; the others stay as a user has set them."""
    return replace_keys(rules, old, ["rule_name"])
