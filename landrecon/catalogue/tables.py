"""Spark frames of the domain tables, with the costly stages written once per data folder."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import nullcontext
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from landrecon.catalogue import derive
from landrecon.functions.arrays import array_text
from landrecon.functions.rings import rect_ring
from landrecon.operators.joins import anti, semi
from landrecon.operators.matching import drop_weaker_pairs
from landrecon.operators.rewrite import one_sided
from landrecon.plans import clean, commons, flags, ownership, reconcile
from landrecon.plans.chain import KEY, hot_parcels
from landrecon.session import ON_DROP, co_located, listing, stage, tune
from landrecon.sources.reference_lists import excluded_land_uses, land_use_rank

# Bytes of the declarations' files for one bucket of the chain, where there is more than the shuffle partitions take.
BUCKET_BYTES = 2 << 20


def plain(df: DataFrame) -> DataFrame:
    """Report types only: decimals as doubles, dates and arrays as text."""
    columns = []
    for field in df.schema.fields:
        col = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            col = col.cast("double")
        elif isinstance(field.dataType, T.DateType):
            col = col.cast("string")
        elif isinstance(field.dataType, T.ArrayType):
            col = array_text(col)
        columns.append(col.alias(field.name))
    return df.select(*columns)


class Chain:
    """The steps D1 to D8 over declarations, each written once. With ``buckets`` these are dealt to as many
    buckets by parcel and no later step shuffles; no parcel may then be too large for a task."""

    def __init__(self, owners: DataFrame, renters: DataFrame, buckets: int | None = None):
        self.owners, self.renters, self.buckets = owners, renters, buckets

    def _in_place(self):
        return nullcontext() if self.buckets is None else co_located(self.owners.sparkSession, KEY, self.buckets)

    def written(self, make: Callable[[], DataFrame], name: str) -> DataFrame:
        with self._in_place():
            return stage(make(), name)

    def _cleaned(self, raw: DataFrame, identity: tuple[str, ...], mark: str) -> DataFrame:
        dealt = raw if self.buckets is None else raw.repartition(self.buckets, KEY)
        return self.written(lambda: clean.clean_declarations(dealt, identity, mark, derive.YEAR_OUT), "clean")

    @cached_property
    def perm_clean(self) -> DataFrame:
        return self._cleaned(self.owners, clean.OWNER_IDENTITY, "P")

    @cached_property
    def seas_clean(self) -> DataFrame:
        return self._cleaned(self.renters, clean.RENTER_IDENTITY, "S")

    @cached_property
    def perm_parcel(self) -> DataFrame:
        return self.written(lambda: clean.repair_parcel_area(self.perm_clean), "parcel")

    @cached_property
    def seas_parcel(self) -> DataFrame:
        return self.written(lambda: clean.repair_parcel_area(self.seas_clean), "parcel")

    @cached_property
    def perm(self) -> DataFrame:
        return self.written(lambda: clean.repair_use_area(clean.repair_parcel_area(self.perm_clean), "owner"), "perm")

    @cached_property
    def seas(self) -> DataFrame:
        return self.written(lambda: clean.repair_use_area(clean.repair_parcel_area(self.seas_clean), "user"), "seas")

    @cached_property
    def matched(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        with self._in_place():
            return reconcile.match_owners_renters(self.perm, self.seas)

    @property
    def pairs(self) -> DataFrame:
        return self.matched[0]

    @cached_property
    def best_pairs(self) -> DataFrame:
        """Pairs but the weaker ones. A claim's id names its parcel."""
        narrow = self.pairs.select(KEY, "claim_id", "tier", "owner_claim_id", "user_claim_id", "owner_land_leased_out")
        return self.written(lambda: drop_weaker_pairs(narrow, within=(KEY,)), "best-pairs")

    @property
    def perm_left(self) -> DataFrame:
        return self.matched[1]

    @property
    def seas_left(self) -> DataFrame:
        return self.matched[2]

    @cached_property
    def final(self) -> DataFrame:
        left, pairs = reconcile.one_sided_rows(self.perm_left, self.seas_left), reconcile.merge_pairs(self.pairs)
        return self.written(lambda: reconcile.infer_and_equalise(left.unionByName(pairs)), "final")

    @cached_property
    def flagged(self) -> DataFrame:
        return self.written(lambda: flags.flag_errors(self.final, self.pairs), "flagged")

    def commons_flagged(self, detail: DataFrame) -> DataFrame:
        return self.written(lambda: commons.flag_commons_fields(self.flagged, detail), "iacs-flagged")

    def linked(self, detail: DataFrame) -> DataFrame:
        """The rows with their commons flags, as what is made of them in place takes them: not written where they lie
        by parcel, as each use reads few of their columns."""
        return self.commons_flagged(detail) if self.buckets is None else commons.flag_commons_fields(self.flagged, detail)

    def commons_parcels(self, linked: DataFrame) -> DataFrame:
        """The list of parcels that are commons fields, written since the rows are read again to be compared with it."""
        return stage(ownership.commons_parcels(linked), "commons-parcels")


class Tables:
    """The given tables and all domain tables derived from them."""

    _known: dict[tuple, "Tables"] = {}

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = tune(spark)
        self.folder = folder.rstrip("/")

    @classmethod
    def of(cls, spark: SparkSession, folder: str) -> "Tables":
        """The same tables for the same session, folder and files in it, so that stages are shared. They
        are forgotten when the stages are dropped."""
        key = (spark.sparkContext.applicationId, id(spark), folder.rstrip("/"), listing(spark, folder))
        if key not in cls._known:
            cls._known[key] = cls(spark, folder)
        return cls._known[key]

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def given(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def _derived(self, name: str, columns: dict[str, str], where: str = "true") -> DataFrame:
        exprs = [f"{expr} AS {alias}" for alias, expr in columns.items()]
        return self.given(name).where(where).selectExpr(*exprs)

    # narrow projections of the given tables
    @property
    def perm_raw(self) -> DataFrame:
        return self._derived("lineitem", derive.DECLARATION, derive.OWNER_FILTER)

    @property
    def seas_raw(self) -> DataFrame:
        return self._derived("lineitem", derive.DECLARATION, derive.RENTER_FILTER)

    @property
    def share(self) -> DataFrame:
        return self._derived("orders", derive.SHARE)

    @property
    def detail(self) -> DataFrame:
        return self._derived("orders", derive.DETAIL)

    @staticmethod
    def _ringed(df: DataFrame) -> DataFrame:
        corners = [F.col(c) for c in ("x0", "y0", "x1", "y1")]
        return df.withColumn("ring", rect_ring(*corners)).drop("x0", "y0", "x1", "y1")

    @property
    def grazing_shape(self) -> DataFrame:
        return self._ringed(self._derived("orders", derive.GRAZING_SHAPE))

    @property
    def parcel_shape(self) -> DataFrame:
        return self._ringed(self._derived("part", derive.PARCEL_SHAPE))

    @property
    def property_shape(self) -> DataFrame:
        return self._ringed(self._derived("supplier", derive.PROPERTY_SHAPE))

    @property
    def digitised(self) -> DataFrame:
        years = F.explode(F.sequence(F.lit(derive.FIRST_YEAR), F.lit(derive.LAST_YEAR)))
        digi = F.expr(derive.DIGITISED).alias("digi_area")
        return self.given("part").select(F.col("p_partkey").alias("hapar_id"), years.alias("year"), digi)

    @property
    def excl(self) -> DataFrame:
        return excluded_land_uses(self.spark)

    @property
    def rank(self) -> DataFrame:
        return land_use_rank(self.spark)

    @property
    def lpid(self) -> DataFrame:
        key = F.concat(F.lit("L"), F.col("cg_hahol_id").cast("string"), F.lit("."), F.col("year").cast("string"))
        return commons.detail_totals(self.detail).withColumn("lpid_id", key)

    # the chain, over all parcels
    @cached_property
    def chains(self) -> list[Chain]:
        """The steps of the parcels, dealt to buckets, and of those too large for that, if there are any."""
        raw = [self.perm_raw, self.seas_raw]
        hot = hot_parcels(*raw)
        size = sum(size for name, size, _ in listing(self.spark, self.folder) if "/lineitem.parquet" in name)
        buckets = max(int(self.spark.conf.get("spark.sql.shuffle.partitions")), size // BUCKET_BYTES)
        if hot.isEmpty():
            return [Chain(*raw, buckets)]
        hot = F.broadcast(hot)  # each has more than HOT_ROWS declarations, so there are few
        return [Chain(*[anti(df, hot, [KEY]) for df in raw], buckets), Chain(*[semi(df, hot, [KEY]) for df in raw])]

    def in_place(self, make: Callable[[Chain], DataFrame], name: str) -> DataFrame:
        """What is made of the chain's rows where they lie, all parcels put together."""
        return reduce(DataFrame.unionByName, [part.written(lambda part=part: make(part), name) for part in self.chains])

    def _of_chains(self, name: str) -> DataFrame:
        return reduce(DataFrame.unionByName, [getattr(part, name) for part in self.chains])

    @property
    def perm_clean(self) -> DataFrame:
        return self._of_chains("perm_clean")

    @property
    def seas_clean(self) -> DataFrame:
        return self._of_chains("seas_clean")

    @property
    def perm_parcel(self) -> DataFrame:
        return self._of_chains("perm_parcel")

    @property
    def seas_parcel(self) -> DataFrame:
        return self._of_chains("seas_parcel")

    @property
    def perm(self) -> DataFrame:
        return self._of_chains("perm")

    @property
    def seas(self) -> DataFrame:
        return self._of_chains("seas")

    @property
    def pairs(self) -> DataFrame:
        return self._of_chains("pairs")

    @property
    def best_pairs(self) -> DataFrame:
        return self._of_chains("best_pairs")

    @property
    def perm_left(self) -> DataFrame:
        return self._of_chains("perm_left")

    @property
    def seas_left(self) -> DataFrame:
        return self._of_chains("seas_left")

    @property
    def final(self) -> DataFrame:
        return self._of_chains("final")

    @property
    def flagged(self) -> DataFrame:
        return self._of_chains("flagged")

    @property
    def sides(self) -> DataFrame:
        """Owner rows and renter rows with the other side empty."""
        left = one_sided(self.perm, clean.MEASURES, "owner")
        return left.unionByName(one_sided(self.seas, clean.MEASURES, "user"))

    def _build_commons(self) -> DataFrame:
        return commons.build_commons(self.share, self.lpid, self.grazing_shape)

    @cached_property
    def commons_built(self) -> DataFrame:
        return stage(self._build_commons())

    @cached_property
    def commons_cleaned(self) -> tuple[DataFrame, DataFrame]:
        """The cleaned commons, written, and the members of their merged rows. Cleaning writes the built rows itself
        once they are held to their grazing's area."""
        done, members = commons.clean_commons(self._build_commons())
        return stage(done), members

    @cached_property
    def commons_logged(self) -> DataFrame:
        """The cleaned commons with their change log."""
        built = stage(commons.build_commons(self.share, self.lpid, self.grazing_shape, log=True))
        return stage(commons.clean_commons(built)[0])

    @property
    def commons(self) -> DataFrame:
        return self.commons_cleaned[0]

    def linked_in_place(self, make: Callable[[Chain, DataFrame], DataFrame], name: str) -> DataFrame:
        """What is made of the rows with their commons flags where they lie. The flags come from the commons' fields,
        not from the table of the commons."""
        return self.in_place(lambda part: make(part, part.linked(self.detail)), name)

    @cached_property
    def commons_claims(self) -> DataFrame:
        """The claims on commons fields, which are copied to the commons."""
        return self.linked_in_place(lambda _, linked: commons.commons_claims(linked), "commons-claims")

    @cached_property
    def linked(self) -> tuple[DataFrame, DataFrame]:
        """Both tables of the cross-link, whole."""
        marked = reduce(DataFrame.unionByName, [part.commons_flagged(self.detail) for part in self.chains])
        return commons.link_flagged(marked, self.commons, self.detail)


ON_DROP.append(Tables._known.clear)
