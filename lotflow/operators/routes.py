"""Ordered supply sources per demand plant."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotflow.session import local_table

# Demand plant and its sources in order, as plant or plant.location
ROUTES = {
    "101A": "101A 701A 381A 481A 111A 921A 482A",
    "111A": "111A 282A",
    "112A": "112A",
    "281A": "281A",
    "282A": "282A 111A",
    "381A": "381A 701A 101A.RM03A 101A.RM04 101A.RM05 101A.RM06 101A.PHTX",
    "382A": "382A",
    "481A": "481A 101A.RM01 101A.PHDT",
    "482A": "482A 101A.RM02",
    "921A": "921A 101A 481A 701A 381A",
    "701A": "701A 381A",
}

ANY = "****"
Bucket = tuple[str, str]


@dataclass
class Phase:
    """How one demand plant draws: from shared sources, then from the bucket of
    the line's own location, then from shared sources again."""

    before: list[Bucket] = field(default_factory=list)
    own: dict[str, Bucket] = field(default_factory=dict)
    after: list[Bucket] = field(default_factory=list)


class Routes:
    """The sourcing table. Sizes depend on the number of plants only, so the
    small DataFrames made from it may be broadcast."""

    def __init__(self, routes: dict[str, str] | None = None):
        self.sources = {plant: text.split() for plant, text in (routes or ROUTES).items()}
        special = [s.split(".", 1) for ss in self.sources.values() for s in ss if "." in s]
        # stock is kept apart for the location as written, but a source reads only
        # its first four characters: a longer location is never reached by its route
        self.special: set[Bucket] = {(plant, location) for plant, location in special}
        self.phases = {plant: self._phase(plant) for plant in self.sources}
        reach = {b for p in self.phases.values() for b in [*p.before, *p.own.values(), *p.after]}
        self.buckets: list[Bucket] = sorted(reach)
        self.bucket_no = {b: i for i, b in enumerate(self.buckets)}
        self.plants = sorted(self.phases)
        self.plant_no = {p: i for i, p in enumerate(self.plants)}
        self.locations = [ANY, *sorted({loc for _, loc in self.special})]
        self.location_no = {loc: i for i, loc in enumerate(self.locations)}

    @staticmethod
    def parse(source: str) -> Bucket:
        plant, _, location = source.partition(".")
        return plant, location[:4] or ANY

    def _phase(self, plant: str) -> Phase:
        phase = Phase()
        for source in dict.fromkeys(self.sources[plant]):
            owned = sorted(loc for p, loc in self.special if p == source)
            if owned:
                if phase.own:
                    raise ValueError(f"route of {plant}: more than one source with own locations")
                phase.own = {ANY: (source, ANY), **{loc: (source, loc) for loc in owned}}
            elif (bucket := self.parse(source)) not in phase.before + phase.after:
                (phase.after if phase.own else phase.before).append(bucket)
        if set(phase.own.values()) & set(phase.before + phase.after):
            raise ValueError(f"route of {plant}: a location both as source and as own location")
        return phase

    def routes_df(self, spark: SparkSession) -> DataFrame:
        """``(demand_plant, priority, source, supply_plant, supply_location)``."""
        rows = [
            (plant, i + 1, source, *self.parse(source))
            for plant, sources in self.sources.items()
            for i, source in enumerate(sources)
        ]
        schema = "demand_plant string, priority int, source string, supply_plant string, supply_location string"
        return local_table(spark, rows, schema)

    def special_df(self, spark: SparkSession) -> DataFrame:
        return local_table(spark, sorted(self.special), "werks string, lgort string")

    def plants_df(self, spark: SparkSession) -> DataFrame:
        return local_table(spark, list(self.plant_no.items()), "werks string, plant_no int")

    def own_df(self, spark: SparkSession) -> DataFrame:
        """Locations that override a source, per demand plant."""
        rows = [
            (plant, loc, self.location_no[loc])
            for plant, phase in self.phases.items()
            for loc in phase.own
            if loc != ANY
        ]
        return local_table(spark, rows, "werks string, lgort string, location_no int")

    def buckets_df(self, spark: SparkSession) -> DataFrame:
        rows = [(plant, loc, i) for (plant, loc), i in self.bucket_no.items()]
        return local_table(spark, rows, "werks string, sto_lgort string, bucket int")


def sourcing_routes(spark: SparkSession, routes: dict[str, str] | None = None) -> DataFrame:
    return Routes(routes).routes_df(spark)


def candidate_sources(demand: DataFrame, routes: dict[str, str] | None = None) -> DataFrame:
    """Each demand line with the buckets it may draw from, in order.

    A source whose plant keeps the line's own location apart is replaced by that
    location. A plant without a route keeps its line with a NULL source.
    """
    spark = demand.sparkSession
    table = Routes(routes)
    sources = table.routes_df(spark).withColumnRenamed("demand_plant", "werks")
    special = table.special_df(spark).select(
        F.col("werks").alias("source"), "lgort", F.lit(True).alias("_own")
    )
    return (
        demand.join(F.broadcast(sources), "werks", "left")
        .join(F.broadcast(special), ["source", "lgort"], "left")
        .withColumn("supply_location", F.when(F.col("_own"), F.col("lgort")).otherwise(F.col("supply_location")))
        .drop("_own", "source")
    )
