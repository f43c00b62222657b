"""Table stores: three tables that can be read and appended to.

Both stores offer ``read(name)`` and ``append(name, rows)``. The folder store
keeps facts by day, so a batch reads the days it touches and no others; the
database store sends the same test to the database.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from envstream import schemas as S
from envstream.functions import name_part
from envstream.session import materialise

LOCATIONS, AIR, WEATHER = "Locations", "AirPollutionData", "WeatherData"
SHAPES = {LOCATIONS: S.LOCATIONS_TABLE, AIR: S.AIR_TABLE, WEATHER: S.WEATHER_TABLE}
DAY = "measurement_date"
#: Part of the dimension's folder, where keys stem from names.
NAME_PART = "name_part"
#: The batch that wrote a row; readers of the tables do not see it.
TAG = "written_by"


def is_placed() -> Column:
    return F.col("longitude").isNotNull() & F.col("latitude").isNotNull()


def utc_day(second: Column) -> Column:
    """The day of a unix second in UTC, whatever the session's time zone."""
    return F.date_from_unix_date(F.floor(second / 86400).cast("int"))


@dataclass(frozen=True)
class FolderStore:
    """Parquet folders under one root; facts partitioned by day.

    With ``fill_nulls`` a location first seen without coordinates gets them
    later, as a further row; ``read`` merges such rows whoever wrote them.

    With ``keyed`` a location's key is a function of its name, so several writers may
    add locations at the same time, each without a look at the highest key; equal
    rows of two writers are merged on read as well. The dimension lies in 256 parts
    by key, of which a batch reads those it touches; facts take the key from the
    name. Their own keys are decimals then. Tables made one way stay that way.
    """

    spark: SparkSession
    root: str
    fill_nulls: bool = False
    keyed: bool = False

    def shape(self, name: str) -> str:
        if self.keyed and name != LOCATIONS:
            return SHAPES[name].replace("_data_id bigint", "_data_id decimal(32,0)", 1)
        return SHAPES[name]

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def tag(self, job: str, batch_id: int) -> str:
        """A job's name stands for one checkpoint: a new one begins at batch 0 again."""
        return f"{job}:{batch_id}"

    def create(self) -> FolderStore:
        """Make the folders; what is there already stays."""
        for name in SHAPES:
            empty = self.spark.createDataFrame([], self.shape(name))
            empty.write.mode("ignore").parquet(self.path(name))
        return self

    def read(self, name: str) -> DataFrame:
        if name != LOCATIONS:
            return self._facts(name).drop(DAY)
        return self._merged(self._locations())

    def _locations(self) -> DataFrame:
        shape = self.shape(LOCATIONS) + (f", {NAME_PART} int" if self.keyed else "")
        return self.spark.read.schema(shape).parquet(self.path(LOCATIONS))

    def locations_near(self, rows: DataFrame) -> DataFrame:
        """The locations in the parts of the dimension that the keys of ``rows`` lie in."""
        touched = [r[0] for r in rows.select(name_part("location_id")).distinct().collect()]
        return self._merged(self._locations().where(F.col(NAME_PART).isin(touched)))

    def _merged(self, rows: DataFrame) -> DataFrame:
        at = F.min(F.when(is_placed(), F.struct("longitude", "latitude")))
        return (
            rows.groupBy("location_id", "location_name")
            .agg(at.alias("at"))
            .select("location_id", "location_name", "at.longitude", "at.latitude")
        )

    def _facts(self, name):
        return self.spark.read.schema(f"{self.shape(name)}, {DAY} date").parquet(self.path(name))

    def _days_of(self, rows: DataFrame) -> Column:
        """The days that ``rows`` touch, as a partition filter."""
        # One value per stretch of days comes to the driver, whatever the number
        # of rows: the first and the last day of each.
        day = utc_day(F.unix_seconds(S.TIME)).alias("day")
        number = F.row_number().over(Window.orderBy("day"))
        touched = rows.select(day).where("day is not null").distinct()
        spans = (
            touched.select("day", F.date_sub("day", number).alias("run"))
            .groupBy("run").agg(F.min("day"), F.max("day")).collect()
        )
        days = F.lit(False)
        for _, low, high in spans:
            days = days | F.col(DAY).between(low, high)
        return days

    def keys_near(self, name: str, rows: DataFrame) -> DataFrame:
        """Keys of the facts on the days that ``rows`` touch."""
        return self._facts(name).where(self._days_of(rows)).select("location_id", S.TIME)

    def written(self, name: str, tag: str, rows: DataFrame) -> int:
        """How many rows of the table bear the tag of a batch, whichever of its runs
        wrote them. Of facts only the days that ``rows`` touch are read."""
        shape = f"{self.shape(name)}, {TAG} string"
        if name != LOCATIONS:
            shape += f", {DAY} date"
        table = self.spark.read.schema(shape).parquet(self.path(name))
        if name != LOCATIONS:
            table = table.where(self._days_of(rows))
        return table.where(F.col(TAG) == tag).count()

    def append(self, name: str, rows: DataFrame, tag: str | None = None) -> int:
        """Append and count; a ``tag`` marks the rows in the files. The files a reader
        of this table sees are fixed when its plan is made, so ``rows`` may stem from
        the table itself."""
        rows = rows.withColumn(TAG, F.lit(tag).cast("string"))
        if name != LOCATIONS:
            # Even files: small days are merged, a day with very many rows is split.
            rows = rows.withColumn(DAY, utc_day(F.unix_seconds(S.TIME))).hint("rebalance", DAY)
        elif self.keyed:
            rows = rows.withColumn(NAME_PART, name_part("location_id")).hint("rebalance", NAME_PART)
        counted = Observation()
        writer = rows.observe(counted, F.count(F.lit(1)).alias("n")).write.mode("append")
        if name != LOCATIONS:
            writer = writer.partitionBy(DAY)
        elif self.keyed:
            writer = writer.partitionBy(NAME_PART)
        writer.parquet(self.path(name))
        return counted.get["n"]


@dataclass(frozen=True)
class DatabaseStore:
    """The same tables behind a JDBC address."""

    spark: SparkSession
    url: str
    properties: dict = field(default_factory=dict)
    writers: int = 8
    read_parts: int | None = None
    fill_nulls = False
    keyed = False

    def tag(self, job: str, batch_id: int) -> None:
        """A database's tables have no place for one."""

    def options(self, name: str, span=None) -> dict:
        """Options for a whole table, or for the keys of its facts in a time span.

        With ``read_parts`` the time span is read in that many queries.
        """
        chosen = {"url": self.url, "dbtable": name, **self.properties}
        if span is not None:
            low, high = span
            chosen["dbtable"] = (
                f"(select location_id, {S.TIME} from {name} "
                f"where {S.TIME} between '{low}' and '{high}') near_keys"
            )
            if self.read_parts:
                chosen |= {
                    "partitionColumn": S.TIME,
                    "lowerBound": low,
                    "upperBound": high,
                    "numPartitions": str(self.read_parts),
                }
        return chosen

    def _load(self, options) -> DataFrame:
        return self.spark.read.format("jdbc").options(**options).load()

    def read(self, name: str) -> DataFrame:
        return self._load(self.options(name))

    def keys_near(self, name: str, rows: DataFrame) -> DataFrame:
        """Keys of the facts in the time range of ``rows``, cut by the database."""
        low, high = rows.agg(F.min(S.TIME).cast("string"), F.max(S.TIME).cast("string")).first()
        if low is None:
            return self.spark.createDataFrame([], f"location_id bigint, {S.TIME} timestamp")
        return self._load(self.options(name, (low, high)))

    def append(self, name: str, rows: DataFrame, tag: None = None) -> int:
        """Append and count. A database shows rows as they come in, so the rows
        are settled first: a retried task must not look at its own output."""
        settled = materialise(rows)
        (
            settled.write.format("jdbc")
            .options(**self.options(name))
            .option("numPartitions", self.writers)
            .mode("append")
            .save()
        )
        return settled.count()
