"""Fields of canonical records brought to shared shapes, with a reason wherever a value is not taken over."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quernel.functions.canonical import canonical_map
from quernel.functions.objectives import objectives
from quernel.functions.shapes import normalize, spawns
from quernel.operators.reconcile import KEY


@dataclass(frozen=True)
class Exclusion:
    """A field of a source that does not mean what the shared field means; a value of it becomes the state unsupported."""

    source: str
    entity_type: str
    field: str
    reason: str


#: Fields whose meaning in their source differs from the shared one.
EXCLUSIONS = (
    Exclusion("allthethings", "quest", "places", "places mix in providers that were inferred"),
    Exclusion("allthethings", "quest", "finishedBy", "finishers were filled in from the starters"),
    Exclusion("allthethings", "quest", "questLevel", "the level declared there is another one"),
    Exclusion("allthethings", "quest", "objectivesText", "the text there is a comment of the catalogue"),
    Exclusion("allthethings", "quest", "zoneOrSort", "where a declaration stands is not where its quest belongs"),
)


def conform_fields(records: DataFrame, exclusions: tuple[Exclusion, ...] = EXCLUSIONS) -> DataFrame:
    """FIELD rows (entity_type, entity_id, source, revision, field, value, state) with outcome and reason.

    records: entity_type, entity_id, source, source_revision, attributes (field -> JSON text), field_states. Of
    every field the first of these holds: its source marks it with a state other than empty (outcome marked,
    the state stays); it is null under the state empty (cleared, the null is a value); an exclusion names it
    (excluded, unsupported); it has a shape and does not fit it (misshapen, the state says how); else it is
    taken in its shared shape (taken). Where spawns hold zones without a point, those come out as a field
    spawnPresence of their own. A state without a value is marked too. Null maps have no fields; repeated records give
    repeated rows. Needs no shuffle.
    """
    none = F.create_map().cast("map<string,string>")
    named = records.select(*KEY, "source", F.col("source_revision").alias("revision"), F.coalesce(canonical_map(F.col("attributes")), none).alias("_a"), F.coalesce("field_states", none).alias("_s"))
    long = named.select(*KEY, "source", "revision", "_a", "_s", F.explode(F.array_union(F.map_keys("_a"), F.map_keys("_s"))).alias("field"))
    long = long.select(*KEY, "source", "revision", "field", F.col("_a")[F.col("field")].alias("text"), F.col("_s")[F.col("field")].alias("mark"))
    marked = F.coalesce(F.col("mark") != "empty", F.lit(False)) | F.col("text").isNull()
    cleared = ~marked & F.coalesce((F.col("mark") == "empty") & (F.col("text") == "null"), F.lit(False))
    reason = F.coalesce(*[F.when((F.col("source") == e.source) & (F.col("entity_type") == e.entity_type) & (F.col("field") == e.field), F.lit(e.reason)) for e in exclusions], F.lit(None).cast("string"))
    open_ = long.select("*", F.when(marked, "marked").when(cleared, "cleared").when(reason.isNotNull(), "excluded").alias("decided"), reason.alias("why"))
    text = F.when(F.col("decided").isNull(), F.col("text"))
    shaped = open_.select("*", normalize(F.col("field"), text).alias("_n"), objectives(F.when(F.col("field") == "objectives", text)).alias("_o"), spawns(F.when(F.col("field") == "spawns", text))["presence"].alias("_p"))
    own = lambda m: F.when(F.col("field") == "objectives", F.col("_o")[m]).otherwise(F.col("_n")[m])
    outcome = F.when(F.col("decided").isNotNull(), F.col("decided")).when(own("state").isNotNull(), "misshapen").otherwise("taken")
    value = F.when(F.col("decided") == "cleared", F.lit("null")).when(F.col("decided").isNull(), own("value"))
    state = F.when(F.col("decided") == "marked", F.coalesce("mark", F.lit("missing"))).when(F.col("decided") == "excluded", "unsupported").when(F.col("decided").isNull(), own("state"))
    why = F.when(F.col("decided") == "marked", F.concat(F.lit("the source marks it "), F.coalesce("mark", F.lit("missing")))).when(F.col("decided") == "excluded", F.col("why")).when(outcome == "misshapen", F.concat(F.lit("its shape is "), own("state")))
    row = lambda field, v, s, o, r: F.struct(field.alias("field"), v.alias("value"), s.alias("state"), o.alias("outcome"), r.alias("reason"))
    missing = F.lit(None).cast("string")
    rows = F.array(row(F.col("field"), value, state, outcome, why), F.when(F.col("_p").isNotNull(), row(F.lit("spawnPresence"), F.col("_p"), missing, F.lit("taken"), missing)))
    return shaped.select(*KEY, "source", "revision", F.explode(F.array_compact(rows)).alias("_r")).select(*KEY, "source", "revision", "_r.*")


def policy_errors(policy: DataFrame, known: DataFrame) -> DataFrame:
    """entity_type, field, source, error: rows of a policy (entity_type, field, source, priority) that break its rules.

    blank: a name is null, empty or has spaces around it; dotted: a field or type holds a dot; repeated source: a
    source stands twice for one field; unknown source: no row of known (source) has it. One row for each rule broken.
    """
    blank = F.greatest(*[F.coalesce((F.trim(c) != F.col(c)) | (F.length(F.trim(c)) == 0), F.lit(True)) for c in ("entity_type", "field", "source")])
    counted = policy.groupBy("entity_type", "field", "source").agg(F.count("*").alias("_n"))
    sources = known.select(F.col("source").alias("_known")).distinct()
    joined = counted.join(sources, F.col("source") == F.col("_known"), "left")
    rules = {"blank": blank, "dotted": F.coalesce(F.col("field").contains(".") | F.col("entity_type").contains("."), F.lit(False)), "repeated source": F.col("_n") > 1, "unknown source": F.col("_known").isNull()}
    found = F.array_compact(F.array(*[F.when(broken, F.lit(name)) for name, broken in rules.items()]))
    return joined.select("entity_type", "field", "source", F.explode(found).alias("error"))


def field_name(column: Column) -> Column:
    """Whether a text is a plain name: letters, digits, underscores and hyphens only; null is none."""
    return F.coalesce(column.rlike(r"^[A-Za-z0-9_-]+$"), F.lit(False))
