"""Shards along a Hilbert curve over metadata, so that files hold narrow ranges of several columns at once.

Each named column is quantised to cells of about equal counts; the cells are a
point of a grid, and a row's place is how far along the grid's Hilbert curve
that point lies.  Rows are dealt to ranges of the curve and sorted there, in
one shuffle, and each task writes a run.  A narrow pass over the runs counts
them, which tells every row's number; the shards are cut at numbers (equal
counts) or at running sums of sizes (equal bytes).  Only runs with a cut inside,
fewer than there are shards, are written again, in two, so that a file is of one
shard.  A manifest says of each file its shard, its rows' first number and the
least and largest value of each column: a reader with conditions on several
columns opens few files, and Parquet's own statistics do the same within them.

Law: by `rows`, shards differ by one row at most; by `bytes`, a shard ends before
the row at which the running sum reaches its share, so shards differ from an equal
share by less than the largest row.

Defined cases: a null in a column has cell 0, before all values, and a null text
has no bytes; a cell, or one value in all columns, may hold much of the table: rows
within it go by `tie` (nulls first), then as they were read, and are dealt to as
many runs as it takes; repeated rows are separate rows; very long texts count and are
written whole; an empty table gives empty shards; the files hold all columns of the
rows, whatever their names, and those added have free names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from memloom.llm.common import bounded_broadcast, documents, free_name
from memloom.tables import delete, scratch

#: A number within a task's output, in the low bits of monotonically_increasing_id.
PLACE = (1 << 33) - 1


@dataclass(frozen=True)
class Grid:
    """The columns that span the grid, and how they are cut.

    bits: of a column's cells; accuracy: of the quantiles, as in percentile_approx.
    """

    columns: tuple[str, ...]
    bits: int = 6
    accuracy: int = 10000


@dataclass(frozen=True)
class Shards:
    """Where shards were written, and the names of the columns that were added."""

    path: str
    curve: str
    place: str
    columns: tuple[str, ...]


def number(df: DataFrame, name: str) -> Column:
    """A column as a double in the same order; of a text, its first six bytes."""
    kind = dict(df.dtypes)[name]
    if kind in ("string", "binary"):
        start = F.substring(F.encode(name, "UTF-8") if kind == "string" else F.col(name), 1, 6)
        return F.conv(F.rpad(F.hex(start), 12, "0"), 16, 10).cast("double")
    if kind in ("date", "timestamp"):
        return F.unix_micros(F.col(name).cast("timestamp")).cast("double")
    return F.col(name).cast("double")


def quantiles(df: DataFrame, grid: Grid) -> list[list[float]]:
    """Where each column is cut into cells of about equal counts: at most 2^bits - 2 values each, of all rows."""
    cells = (1 << grid.bits) - 1
    shares = [k / cells for k in range(1, cells)]
    found = df.agg(*[F.percentile_approx(number(df, c), shares, grid.accuracy) for c in grid.columns]).first()
    return [sorted(set(values or [])) for values in found]


def cell(value: Column, cuts: list[float]) -> Column:
    """0 for null, else one more than the cuts up to the value."""
    return F.when(value.isNull(), 0).otherwise(1 + F.size(F.filter(F.array(*[F.lit(c) for c in cuts]).cast("array<double>"), lambda c: c <= value)))


def hilbert_index(cells: list[Column], bits: int) -> Column:
    """How far along the Hilbert curve a point lies whose coordinates have so many bits.

    From the highest bits down, each level tells which of 2^n cells the point is
    in, as seen from where the curve enters the level (e) and in which direction
    it leaves (d); both follow from the cell's place w along the Gray code.
    """
    n = len(cells)
    gray = [w ^ (w >> 1) for w in range(1 << n)]
    ones = [next(k for k in range(n + 2) if not w >> k & 1) for w in range((1 << n) + 1)]
    enters = [gray[2 * ((w - 1) // 2)] if w else 0 for w in range(1 << n)]
    leaves = [0 if not w else ones[w - 1 if w % 2 == 0 else w] % n for w in range(1 << n)]
    along = sorted(range(1 << n), key=lambda w: gray[w])
    table = lambda values: F.array(*[F.lit(v) for v in values])
    left = lambda x, by: F.call_function("shiftleft", x, by)
    right = lambda x, by: F.call_function("shiftright", x, by)
    mask = (1 << n) - 1

    def level(at: Column, bit: Column) -> Column:
        corner = F.lit(0)
        for j, c in enumerate(cells):
            corner = corner + right(c, bit).bitwiseAND(1) * (1 << j)
        turned = corner.bitwiseXOR(at["e"])
        by = at["d"] + 1
        seen = right(turned, by).bitwiseOR(left(turned, n - by)).bitwiseAND(mask)
        return F.struct(at["h"], at["e"], at["d"], F.get(table(along), seen).alias("w"))

    def step(at: Column, bit: Column) -> Column:
        # w is used four times: a fold over one element names it.
        def move(s: Column, x: Column) -> Column:
            w, by = x["w"], s["d"] + 1
            entry = F.get(table(enters), w)
            turned = left(entry, by).bitwiseOR(right(entry, n - by)).bitwiseAND(mask)
            return F.struct((s["h"] * (1 << n) + w).alias("h"), s["e"].bitwiseXOR(turned).alias("e"), ((s["d"] + F.get(table(leaves), w) + 1) % n).alias("d"))

        return F.aggregate(F.array(level(at, bit)), at, move)

    start = F.struct(F.lit(0).cast("long").alias("h"), F.lit(0).alias("e"), F.lit(0).alias("d"))
    return F.aggregate(F.array(*[F.lit(b) for b in reversed(range(bits))]), start, step)["h"]


def place_on_curve(cells: list[Column], bits: int) -> Column:
    """hilbert_index of cells that are dear to work out: each is, once a row."""
    once = F.transform(F.array(F.array(*cells)), lambda p: hilbert_index([F.get(p, F.lit(j)) for j in range(len(cells))], bits))
    return F.get(once, F.lit(0))


def size_of(text: Column) -> Column:
    """Bytes of a text, and one more."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def write_shards(df: DataFrame, grid: Grid, tie: str, shards: int = 16, law: str = "rows", text: str = "text", path: str | None = None, run_rows: int = 50_000) -> Shards:
    """Writes df as shards below path and returns where they are.

    run_rows: about so many rows make a file.
    """
    if law not in ("rows", "bytes"):
        raise ValueError(f"law must be rows or bytes, not {law!r}")
    if len(grid.columns) < 2 or len(grid.columns) * grid.bits > 62:
        raise ValueError("a grid has two columns or more, and 62 bits at most")
    spark = df.sparkSession
    path = path or scratch(spark, "shards")
    curve, place, source = (free_name(c, df) for c in ("_curve", "_place", "_source"))
    cuts = quantiles(df, grid)
    total = df.count()
    cells = [cell(number(df, c), own) for c, own in zip(grid.columns, cuts)]
    rows = df.withColumns({curve: place_on_curve(cells, grid.bits), source: F.monotonically_increasing_id()})
    keys = [curve, tie, source]
    runs = rows.repartitionByRange(max(shards, -(-total // run_rows)), *keys).sortWithinPartitions(*keys).drop(source)
    runs.withColumn(place, F.monotonically_increasing_id()).write.parquet(f"{path}/rows/runs")
    made = Shards(path, curve, place, grid.columns)

    files = described(spark.read.parquet(f"{path}/rows/runs"), made, text)
    files.write.parquet(f"{path}/described")
    files = spark.read.parquet(f"{path}/described")
    parts = files.groupBy("part").agg(F.sum("n").alias("_n"), F.sum("bytes").alias("_b"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # A row for each task that wrote a run.
    based = parts.select("part", "_n", "_b", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}0") for c in ("_n", "_b")]).collect()
    starts = [0, *((s * total // shards for s in range(1, shards)) if law == "rows" else byte_cuts(spark, made, based, shards, text))]
    split = [r["part"] for r in based if any(r["_n0"] < c < r["_n0"] + r["_n"] for c in starts)]
    bases = spark.createDataFrame([(r["part"], r["_n0"]) for r in based], "part long, base long")
    shard_of = lambda first: F.size(F.filter(F.array(*[F.lit(c) for c in starts]), lambda c: c <= first)) - 1
    whole = files.where(~F.col("part").isin(split))
    if split:
        rows = spark.read.parquet(f"{path}/rows/runs")
        part, base, shard = (free_name(c, rows) for c in ("_part", "_base", "_shard"))
        rows = rows.withColumn(part, F.shiftright(place, 33)).where(F.col(part).isin(split)).join(F.broadcast(bases.toDF(part, base)), part)
        rows = rows.withColumn(shard, shard_of(F.col(base) + F.col(place).bitwiseAND(PLACE))).drop(part, base)
        rows.sortWithinPartitions(shard, place).write.partitionBy(shard).parquet(f"{path}/rows/cuts")
        halves = spark.read.option("recursiveFileLookup", "true").parquet(f"{path}/rows/cuts")
        whole = whole.unionByName(described(halves, made, text))
    listed = whole.join(F.broadcast(bases), "part").withColumn("shard", shard_of(F.col("base") + F.col("first")))
    listed = listed.withColumn("shard_start", F.get(F.array(*[F.lit(c) for c in starts]).cast("array<bigint>"), F.col("shard")))
    listed.write.parquet(f"{path}/manifest")
    for r in files.where(F.col("part").isin(split)).select("file").collect() if split else []:
        delete(spark, f"{path}/rows/{r['file']}")
    delete(spark, f"{path}/described")
    return made


def file_name() -> Column:
    """A file's name below the folder of all rows; halves of a run have one name in two folders."""
    return F.substring_index("_metadata.file_path", "/rows/", -1)


def described(rows: DataFrame, made: Shards, text: str) -> DataFrame:
    """file, part (the task that wrote its rows), first place, n, bytes, and the least and largest of curve and columns."""
    ends = [f(c).alias(f"{name}_{c}") for c in made.columns for name, f in (("least", F.min), ("most", F.max))]
    numbers = F.col(made.place)
    return rows.groupBy(file_name().alias("file"), F.shiftright(numbers, 33).alias("part")).agg(
        F.min(numbers.bitwiseAND(PLACE)).alias("first"), F.count("*").alias("n"), F.sum(size_of(F.col(text))).alias("bytes"), F.min(made.curve).alias("least_curve"), F.max(made.curve).alias("most_curve"), *ends
    )


def byte_cuts(spark: SparkSession, made: Shards, based: list, shards: int, text: str) -> list[int]:
    """The numbers of the rows at which the running sum of sizes reaches each share; only the runs where that happens are read."""
    total = sum(r["_b"] for r in based)
    wanted = []
    for s in range(1, shards):
        share = -(-s * total // shards)
        inside = [r for r in based if r["_b0"] < share <= r["_b0"] + r["_b"]]
        wanted += [(r["part"], r["_n0"], share - r["_b0"]) for r in inside]
    if not wanted:
        return [0] * (shards - 1)
    rows = spark.read.parquet(f"{made.path}/rows/runs").select(F.shiftright(made.place, 33).alias("part"), F.col(made.place).bitwiseAND(PLACE).alias("at"), size_of(F.col(text)).alias("size"))
    shares = F.broadcast(spark.createDataFrame(wanted, "part long, base long, share long"))
    running = rows.where(F.col("part").isin([w[0] for w in wanted])).withColumn("sum", F.sum("size").over(Window.partitionBy("part").orderBy("at")))
    reached = running.join(shares, "part").where("sum >= share").groupBy("part", "base", "share").agg(F.min("at").alias("at"))
    found = {(r["part"], r["share"]): r["base"] + r["at"] for r in reached.collect()}
    return [found[part, share] for part, _, share in wanted]


def read_manifest(spark: SparkSession, made: Shards) -> DataFrame:
    """A row for each file and run in it: file, part, shard, shard_start, base and first (numbers of rows), n, bytes, least_ and most_ of curve and columns."""
    return spark.read.parquet(f"{made.path}/manifest")


def files_for(manifest: DataFrame, **within: tuple) -> DataFrame:
    """The manifest's files that may hold rows whose columns lie within (least, most), both included; a file's nulls aren't asked for."""
    for name, (least, most) in within.items():
        manifest = manifest.where((F.col(f"most_{name}") >= F.lit(least)) & (F.col(f"least_{name}") <= F.lit(most)))
    return manifest


def read_shards(spark: SparkSession, made: Shards, columns: tuple[str, ...], shard: str = "shard", slot: str = "slot") -> DataFrame:
    """columns (names of the files' own) of all rows, read from the files, with each row's shard and its number there."""
    rows = spark.read.option("recursiveFileLookup", "true").parquet(f"{made.path}/rows")
    rows = rows.select(*columns, F.col(made.place).alias("_at"), F.shiftright(made.place, 33).alias("_part"), file_name().alias("_file"))
    # A file of cut runs may hold the ends of several, each with its own numbers.
    files = read_manifest(spark, made).select(F.col("file").alias("_file"), F.col("part").alias("_part"), F.col("shard").alias("_s"), (F.col("base") - F.col("shard_start")).alias("_from"))
    placed = rows.join(bounded_broadcast(files, F.octet_length("_file") + 24), ["_file", "_part"])
    return placed.select(*columns, F.col("_s").cast("int").alias(shard), (F.col("_from") + F.col("_at").bitwiseAND(PLACE)).alias(slot))


def shard_report(docs: DataFrame, grid: Grid, shards: int = 16, law: str = "rows") -> DataFrame:
    """What the files say of each document: its size, text, shard and slot."""
    made = write_shards(docs, grid, "doc_id", shards, law)
    read = read_shards(docs.sparkSession, made, ("doc_id", "text"))
    crc = F.crc32(F.coalesce("text", F.lit("")).cast("binary"))
    return read.select("doc_id", size_of(F.col("text")).alias("size"), crc.alias("text_crc32"), F.lit(law).alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op12_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_report(documents(spark, sf_dir), Grid(("lang", "source", "n_chars", "doc_id")))
