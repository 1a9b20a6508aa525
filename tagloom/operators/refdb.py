"""Reference database of taxon-unique tags (survey G4-G7, G18-G20, F20-F24, O1-O4)."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.enzymes import Enzyme
from tagloom.functions import seq as S
from tagloom.operators.digest import genome_tags
from tagloom.operators.numbering import numbered
from tagloom.session import checkpointed

LINEAGE = ("kingdom", "phylum", "tax_class", "tax_order", "family", "genus", "species")


def unique_tags(master: DataFrame, single_copy: bool = True, scope: tuple[str, ...] = ()) -> DataFrame:
    """(scope, tag, genome_id, taxon, copies) of tags confined to one taxon.

    ``master``: (scope, genome_id, taxon, tag, copies). The test looks at all copies; with
    ``single_copy`` only genomes that hold the tag once are given. min = max over the tag is
    partially aggregated before the shuffle, so a tag that sits in a third of the genomes is no
    hot group.
    """
    keys = [*scope, "tag"]
    confined = (
        master.groupBy(*keys).agg(F.min("taxon").alias("_low"), F.max("taxon").alias("_high")).where("_low = _high").select(*keys)
    )
    rows = master.where("copies = 1") if single_copy else master
    return rows.join(confined, keys, "left_semi").select(*keys, "genome_id", "taxon", "copies")


def unique_stats(unique: DataFrame, single_copy: bool = True, scope: tuple[str, ...] = ()) -> DataFrame:
    """(scope, genome_id, taxon, genome_tags, taxon_mean).

    The mean is over the genomes of a taxon that have a unique tag. Copies add up where the tags
    are not single-copy.
    """
    n = F.count("*") if single_copy else F.sum("copies")
    genomes = unique.groupBy(*scope, "taxon", "genome_id").agg(n.alias("genome_tags"))
    means = genomes.groupBy(*scope, "taxon").agg(F.avg("genome_tags").alias("taxon_mean"))
    return genomes.join(means, [*scope, "taxon"])


def valid_entries(genomes: DataFrame) -> DataFrame:
    """Entries with a species that is no placeholder."""
    name = F.trim("species")
    return genomes.where(name.isNotNull() & ~name.isin("", "NA", "N/A", "-"))


def with_numbers(genomes: DataFrame, size: int = 30_000, first: int = 0) -> DataFrame:
    """genome_id (eight digits) in the order of source_id and the shard of each."""
    return numbered(genomes, "source_id", name="_n", first=first).withColumns(
        {"genome_id": S.genome_number(F.col("_n")), "shard": S.shard_boundary(F.col("_n"), size)}
    ).drop("_n")


def assign_ids(genomes: DataFrame, mode: str = "auto", size: int = 30_000, first: int = 0) -> DataFrame:
    """O1: genome_id and shard by an id mode.

    ``preserve`` keeps source ids of eight digits and fails where one is not or comes twice;
    ``reassign`` numbers anew; ``auto`` keeps them where it can.
    """
    if mode not in ("auto", "preserve", "reassign"):
        raise ValueError(f"unknown id mode {mode!r}")
    if mode != "reassign":
        proper = F.coalesce(F.col("source_id").rlike(r"^\d{8}$"), F.lit(False))
        facts = genomes.agg(F.count("*").alias("n"), F.count_if(proper).alias("proper"), F.count_distinct("source_id").alias("ids")).first()
        if facts["n"] == facts["proper"] == facts["ids"]:
            return genomes.withColumns({"genome_id": F.col("source_id"), "shard": S.shard_boundary(F.col("source_id").cast("long"), size)})
        if mode == "preserve":
            raise ValueError("ids can be preserved only where all are eight digits and different")
    return with_numbers(genomes, size, first)


def shard_size(boundaries: DataFrame, column: str = "shard") -> int:
    """The shard size of a database that doesn't name it: the greatest common divisor of its shards' bounds.

    There is one bound for each shard, so the distinct ones are few.
    """
    size = math.gcd(*[r[0] for r in boundaries.select(column).where(F.col(column) > 0).distinct().collect()])
    if not size:
        raise ValueError("no shard to infer the size from")
    return size


def legacy_id_map(genomes: DataFrame, prefix: str = "legacy_") -> DataFrame:
    """(source_id, genome_id) of a database without an id map; fails on ids that are not eight digits or come twice."""
    bad = F.when(F.coalesce(F.col("genome_id").rlike(r"^\d{8}$"), F.lit(False)) & (F.col("_n") == 1), F.lit(True)).otherwise(
        F.raise_error(F.concat(F.lit("no id of its own: "), F.coalesce("genome_id", F.lit("null"))))
    )
    return genomes.groupBy("genome_id").agg(F.count("*").alias("_n")).where(bad).select(F.concat(F.lit(prefix), "genome_id").alias("source_id"), "genome_id")


def shard_summary(genomes: DataFrame, size: int = 30_000) -> DataFrame:
    """(shard, genomes, first_id, last_id) of numbered genomes."""
    return genomes.groupBy("shard").agg(F.count("*").alias("genomes"), F.min("genome_id").alias("first_id"), F.max("genome_id").alias("last_id"))


def stats_mismatches(stats: DataFrame, unique: DataFrame, tolerance: float = 1e-4) -> DataFrame:
    """genomes whose written count or mean differs from a recount, or that only one side has (``again``: the recount's id)."""
    recount = unique_stats(unique).select(F.col("genome_id").alias("again"), F.col("genome_tags").alias("_tags"), F.col("taxon_mean").alias("_mean"))
    same = (F.col("genome_tags") == F.col("_tags")) & (F.abs(F.col("taxon_mean") - F.col("_mean")) <= tolerance)
    return stats.join(recount, F.col("genome_id") == F.col("again"), "full").where(~F.coalesce(same, F.lit(False)))


def repeated(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur more than once, with their number."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def lineage_conflicts(genomes: DataFrame) -> DataFrame:
    """Species with more than one lineage."""
    lineage = F.concat_ws("|", *[F.coalesce(c, F.lit("")) for c in LINEAGE[:-1]])
    return valid_entries(genomes).groupBy("species").agg(F.count_distinct(lineage).alias("lineages")).where("lineages > 1")


def harmonise(new: DataFrame, old: DataFrame) -> DataFrame:
    """new entries with the lineage of the old entries of their species; ``changed`` tells where.

    An old species with several lineages gives the least of them.
    """
    ranks = LINEAGE[:-1]
    known = old.groupBy("species").agg(F.min(F.struct(*ranks)).alias("_old"))
    joined = new.join(known, "species", "left")
    changed = F.col("_old").isNotNull() & F.array_contains(F.array(*[~F.col(c).eqNullSafe(F.col(f"_old.{c}")) for c in ranks]), True)
    return joined.withColumn("changed", F.coalesce(changed, F.lit(False))).withColumns(
        {c: F.when(F.col("_old").isNotNull(), F.col(f"_old.{c}")).otherwise(F.col(c)) for c in ranks}
    ).drop("_old")


def set_difference(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys of one side only, with the side."""
    a, b = left.select(key).distinct(), right.select(key).distinct()
    return a.join(b, key, "left_anti").withColumn("side", F.lit("left")).unionByName(
        b.join(a, key, "left_anti").withColumn("side", F.lit("right"))
    )


def shared_keys(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys of both sides."""
    return left.select(key).distinct().join(right.select(key).distinct(), key, "left_semi")


def all_keys(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys of either side, each once."""
    return left.select(key).unionByName(right.select(key)).distinct()


def build_database(genomes: DataFrame, enzyme: Enzyme, path: str, id_mode: str = "auto", size: int = 30_000, mode: str = "errorifexists") -> None:
    """A database of ``genomes`` (source_id, lineage, seq): ``build`` and the table ``genomes`` with ids and shards.

    The species is the taxon; entries without one are left out.
    """
    _write_database(assign_ids(valid_entries(genomes), id_mode, size), enzyme, path, mode)


def update_database(new: DataFrame, enzyme: Enzyme, old_path: str, path: str) -> None:
    """Old and new genomes as a database at a new path.

    New ids start at the old database's last shard bound. Species that it knows keep its lineage, and
    uniqueness is decided anew over all genomes. A source_id of the old database among the new is an error.
    """
    spark = new.sparkSession
    old = spark.read.parquet(f"{old_path}/genomes")
    if again := shared_keys(old, new, "source_id").limit(1).collect():
        raise ValueError(f"already in the database: {again[0][0]}")
    first = old.agg(F.max("shard")).first()[0]
    added = with_numbers(harmonise(valid_entries(new), old).drop("changed"), shard_size(old), first)
    _write_database(added, enzyme, path, "errorifexists", old_path)


def _write_database(numbered_genomes: DataFrame, enzyme: Enzyme, path: str, mode: str, old_path: str | None = None) -> None:
    spark = numbered_genomes.sparkSession
    own = checkpointed(numbered_genomes)
    tables = {"genomes": own.drop("seq")}
    tags = genome_tags(own.withColumn("taxon", F.col("species")), enzyme, ["genome_id", "taxon", "shard"]).withColumn("enzyme", F.lit(enzyme.name))
    tables["master_tags"] = tags
    for name, by in (("genomes", ()), ("master_tags", ("enzyme", "shard"))):
        rows = tables[name]
        if old_path:
            rows = spark.read.parquet(f"{old_path}/{name}").unionByName(rows)
        rows.write.mode(mode).partitionBy(*by).parquet(f"{path}/{name}") if by else rows.write.mode(mode).parquet(f"{path}/{name}")
    _write_unique(spark.read.parquet(f"{path}/master_tags"), path, mode)
    manifest(spark, path, enzyme).write.mode(mode).json(f"{path}/manifest")


def manifest(spark: SparkSession, path: str, enzyme: Enzyme) -> DataFrame:
    """One row that describes a database: its numbers and an order-free checksum of its master tags."""
    master, unique, genomes = (spark.read.parquet(f"{path}/{t}") for t in ("master_tags", "unique_tags", "genomes"))
    own = master.where(F.col("enzyme") == enzyme.name)
    return (
        own.agg(F.count("*").alias("relations"), F.expr("bit_xor(xxhash64(tag, genome_id, copies))").alias("checksum"))
        .withColumns({"enzyme": F.lit(enzyme.name), "genomes": F.lit(genomes.count()), "shard_size": F.lit(shard_size(genomes)), "unique_tags": F.lit(unique.where(F.col("enzyme") == enzyme.name).count())})
    )


def master_of(spark: SparkSession, path: str, ids: DataFrame, size: int) -> DataFrame:
    """Master tags of some genomes; only the shards of their ids are read.

    The distinct shards of the ids are few and name the partitions; the ids themselves meet by a join.
    """
    shards = [r[0] for r in ids.select(S.shard_boundary(F.col("genome_id").cast("long"), size)).distinct().collect()]
    return spark.read.parquet(f"{path}/master_tags").where(F.col("shard").isin(shards)).join(ids.select("genome_id").distinct(), "genome_id", "left_semi")


def look_up(spark: SparkSession, path: str, tags: DataFrame) -> DataFrame:
    """Unique tags of a database for the tags asked for, with genome and taxon."""
    return tags.select("tag").distinct().join(spark.read.parquet(f"{path}/unique_tags"), "tag")


def totals(master: DataFrame, unique: DataFrame) -> DataFrame:
    """(relations, tags, copies, unique_rows, unique_tags) of a database."""
    m = master.agg(F.count("*").alias("relations"), F.count_distinct("tag").alias("tags"), F.sum("copies").alias("copies"))
    u = unique.agg(F.count("*").alias("unique_rows"), F.count_distinct("tag").alias("unique_tags")).first()
    return m.withColumns({"unique_rows": F.lit(u["unique_rows"]), "unique_tags": F.lit(u["unique_tags"])})


def build(genomes: DataFrame, enzyme: Enzyme, path: str, mode: str = "errorifexists") -> None:
    """Write master and unique tags of ``genomes`` (genome_id, taxon, seq) as Parquet.

    The tables are clustered by tag, so that the join with read tags finds both sides sorted
    within row groups and prunes by their statistics.
    """
    genome_tags(genomes, enzyme, ["genome_id", "taxon"]).withColumn("enzyme", F.lit(enzyme.name)).write.mode(mode).partitionBy(
        "enzyme"
    ).parquet(f"{path}/master_tags")
    _write_unique(genomes.sparkSession.read.parquet(f"{path}/master_tags"), path, mode)


def _write_unique(master: DataFrame, path: str, mode: str) -> None:
    unique = unique_tags(master, scope=("enzyme",))
    unique.repartition("tag").sortWithinPartitions("tag").write.mode(mode).partitionBy("enzyme").parquet(f"{path}/unique_tags")
    unique_stats(unique, scope=("enzyme",)).write.mode(mode).parquet(f"{path}/unique_stats")


def update(new: DataFrame, enzyme: Enzyme, old_path: str, path: str) -> None:
    """O2: old and new genomes at a new path; uniqueness is decided anew over all of them."""
    spark = new.sparkSession
    old = spark.read.parquet(f"{old_path}/master_tags")
    if shared_keys(old, new, "genome_id").limit(1).count():
        raise ValueError("new genomes carry ids of old ones")
    added = genome_tags(new, enzyme, ["genome_id", "taxon"]).withColumn("enzyme", F.lit(enzyme.name))
    old.unionByName(added).write.partitionBy("enzyme").parquet(f"{path}/master_tags")
    _write_unique(spark.read.parquet(f"{path}/master_tags"), path, "errorifexists")


def violations(master: DataFrame, unique: DataFrame, enzyme: Enzyme) -> DataFrame:
    """(problem, n) of structural checks; no rows for a sound database."""
    bad_tag = ~F.col("tag").rlike("^[ACGT]+$") | (F.length("tag") != enzyme.length)
    checks = [
        master.where(bad_tag | F.col("tag").isNull()).select(F.lit("malformed tag").alias("problem")),
        master.where("copies < 1 or copies is null").select(F.lit("copies below one").alias("problem")),
        repeated(master, "genome_id", "tag").select(F.lit("repeated relation").alias("problem")),
        unique.groupBy("tag").agg(F.count_distinct("taxon").alias("n")).where("n > 1").select(F.lit("tag of two taxa").alias("problem")),
        unique.join(master.where("copies = 1"), ["genome_id", "tag"], "left_anti").select(F.lit("not in the master table").alias("problem")),
    ]
    rows = checks[0]
    for c in checks[1:]:
        rows = rows.unionByName(c)
    return rows.groupBy("problem").agg(F.count("*").alias("n"))
