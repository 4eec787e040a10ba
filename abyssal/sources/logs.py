"""Lander and surface log text to typed tables, as one distributed projection over a text scan."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from abyssal.functions.common import once, shared_dir, write_and_read
from abyssal.functions.text import iso_timestamp, nullable_number, number, strip, truncated
from abyssal.schemas import KEY, TABLES

# File-name patterns of the three log kinds and the vocabularies of the valve line.
FILE_PATTERNS = {
    "gems": (r"^gems_(\d{4}-\d{2}-\d{2}-\d{2}-\d{2})\.txt$", "gems_*.txt"),
    "surface": (r"^surface_(\d{4}-\d{2}-\d{2}-\d{2}-\d{2})_lander\.log$", "surface_*_lander.log"),
    "events": (r"^surface_(\d{4}-\d{2}-\d{2}-\d{2}-\d{2})_events\.log$", "surface_*_events.log"),
}
CHAMBERS = ("C1", "C2")
FLUSH_STATES = ("Re", "Fl", "Unknown")
TABLE_OF = {"R": "rga", "V": "valve", "P": "scalup", "!": "status"}
BATTERY = (
    r"^(\S+)\s+SYSTEM\s+battery\s+voltage=([-\d.]+)V\s+current=([-\d.]+)A\s+temp=([-\d.]+)C$"
)


def rotation_ts(file_name: Column, kind: str) -> Column:
    """Rotation time in the file name; null when the name is not exactly of this kind."""
    stamp = F.regexp_extract(file_name, FILE_PATTERNS[kind][0], 1)
    return F.try_to_timestamp(F.when(stamp != "", stamp), F.lit("yyyy-MM-dd-HH-mm")).cast("timestamp_ntz")


def deployment_of(path: Column, root: str, ids: Sequence[str] | None = None, encoded: bool = True) -> Column:
    """The deployment's folder in a file's path below the root: the deepest one named in ``ids``, else the first.

    The root is taken as plain text. File URIs are decoded (per cent escapes only, a plus is a plus).
    """
    plain = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))) if encoded else path
    bare = re.sub(r"^[a-z][a-z0-9+.-]*:(//[^/]*)?", "", root).rstrip("/") + "/"
    rest = F.substring(plain, F.instr(plain, bare) + F.lit(len(bare)), F.length(plain))
    folders = F.split(F.regexp_extract(rest, "^(.*)/[^/]*$", 1), "/")
    first = F.element_at(folders, 1)
    if not ids:
        return first
    return F.coalesce(F.try_element_at(F.filter(folders, lambda f: f.isin(list(ids))), F.lit(-1)), first)


def list_files(spark: SparkSession, root: str, kind: str, ids: Sequence[str] | None = None) -> DataFrame:
    """Files of one kind below the root with their rotation time; empty and misnamed ones left out.

    Only names and lengths are read, never contents.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", FILE_PATTERNS[kind][1])
        .load(root)
        .where("length > 0")
    )
    name = F.element_at(F.split("path", "/"), -1)
    return files.select(
        deployment_of(F.col("path"), root, ids, encoded=False).alias(KEY),
        F.lit(kind).alias("kind"),
        name.alias("file_name"),
        rotation_ts(name, kind).alias("rotation_ts"),
    ).where("rotation_ts IS NOT NULL")


def list_log_files(spark: SparkSession, root: str) -> DataFrame:
    """Both log sources; order by (rotation_ts, source_rank) puts the lander's own file first on ties."""
    gems = list_files(spark, root, "gems").withColumn("source_rank", F.lit(0))
    return gems.unionByName(list_files(spark, root, "surface").withColumn("source_rank", F.lit(1)))


def with_file_facts(spark: SparkSession, lines: DataFrame, root: str, glob: str, facts: dict[str, Column]) -> DataFrame:
    """Lines (column file_path) with what follows from their file's path and name alone, made once per file instead of once per line.

    ``facts`` are columns over file_path and file_name. The listing holds names only, one row per file, and is broadcast: the driver's
    index of the scan lists the same files.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(root)
    named = listed.select(F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_name").alias("file_name"))
    known = named.select("file_path", "file_name", *[c.alias(n) for n, c in facts.items()])
    return lines.join(F.broadcast(write_and_read(known)), "file_path")


def scan_text(spark: SparkSession, root: str, kinds: tuple[str, ...], ids: Sequence[str] | None = None) -> DataFrame:
    """Lines of the given kinds with the arrival-order key.

    ``chunk`` is one input split as a sortable string (rotation time, source, path, split offset) and
    ``pos`` numbers its lines, so order survives file splitting and no chunk exceeds a split.
    """
    glob = "{" + ",".join(FILE_PATTERNS[k][1] for k in kinds) + "}"
    raw = (
        spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob).text(root)
    ).select(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("pos"),
        strip(F.make_valid_utf8("value")).alias("line"),
    )
    rot = F.coalesce(*[rotation_ts(F.col("file_name"), k) for k in kinds])
    rank = F.when(F.col("file_name").startswith("surface_"), F.lit("1")).otherwise(F.lit("0"))
    file_chunk = F.when(rot.isNotNull(), F.concat_ws("|", F.date_format(rot, "yyyyMMddHHmm"), rank, "file_path"))
    facts = {KEY: deployment_of(F.col("file_path"), root, ids), "file_chunk": file_chunk}
    known = with_file_facts(spark, raw, root, glob, facts).where("file_chunk IS NOT NULL")
    chunk = F.concat("file_chunk", F.lit("|"), F.lpad(F.col("block_start").cast("string"), 15, "0"))
    return known.select(KEY, "file_name", chunk.alias("chunk"), "pos", "line")


def payloads(lines: DataFrame) -> DataFrame:
    """Envelope strip: surface lines lose receipt time (kept as text) and `#` headers; empty lines go."""
    surface = F.col("file_name").startswith("surface_")
    body = F.regexp_extract("line", r"^\S+\s+(.+)$", 1)
    return (
        lines.where((F.col("line") != "") & ~(surface & F.col("line").startswith("#")))
        .withColumn("receipt", F.when(surface, F.regexp_extract("line", r"^(\S+)", 1)))
        .withColumn("payload", F.when(surface, body).otherwise(F.col("line")))
        .where("payload != ''")
    )


def _fields(payload: Column) -> Column:
    return F.split(F.substring(payload, 3, 1_000_000_000), ",")


def parse_payload(lines: DataFrame, payload: str = "payload") -> DataFrame:
    """Add ``tag`` and every typed field of the line grammar; ``tag`` is null for lines out of scope.

    R: three fields, all needed. V: three fields, closed vocabularies. P: 6, 7 or 8 fields, only the time
    is needed. !: time and ten numbers, any other count goes to payload_raw.
    """
    p, f = F.col(payload), F.col("__f")
    n = F.size(f)
    at = lambda i: F.get(f, F.lit(i))
    ts = F.col("ts")
    is_r, is_v = p.startswith("R:") & (n == 3), p.startswith("V:") & (n == 3)
    is_p = p.startswith("P:") & n.isin(6, 7, 8)
    is_s = p.startswith("!:")
    full = is_s & (n == 11)
    numbers = lambda first, count: F.transform(F.slice(f, first + 1, count), nullable_number)
    mass, current = truncated(F.get("__r", F.lit(0))), F.get("__r", F.lit(1))
    value = lambda i: F.get("__x", F.lit(i - 1))
    late = lambda i: F.when(n == 6, value(i - 1)).otherwise(value(i))
    tag = (
        F.when(is_r & ts.isNotNull() & mass.isNotNull() & current.isNotNull(), F.lit("R"))
        .when(is_v & ts.isNotNull() & at(1).isin(*CHAMBERS) & at(2).isin(*FLUSH_STATES), F.lit("V"))
        .when(is_p & ts.isNotNull(), F.lit("P"))
        .when(is_s & ts.isNotNull(), F.lit("!"))
    )
    status = [
        "turbo_error", "turbo_speed_hz", "turbo_power_w", "turbo_voltage", "turbo_etemp_c", "turbo_btemp_c",
        "turbo_mtemp_c", "rga_filament", "raw_total_pressure_current", "pump_rpm",
    ]
    # A table's rows are picked by tag: fields, time and tag are made once, the values only of the rows that stay.
    rows = once(once(lines, "__f", _fields(p)), "ts", iso_timestamp(at(0)))
    rows = once(once(rows, "__r", F.when(is_r, numbers(1, 2))), "tag", tag)
    out = rows.withColumn("__x", F.when(is_p | full, numbers(1, 10))).withColumns(
        {
            "mass": mass,
            "current": current,
            "chamber": F.when(is_v, at(1)),
            "flush_state": F.when(is_v, at(2)),
            "ts_scalup": F.when(is_p, iso_timestamp(at(1))),
            "temp_degc": F.when(is_p, value(2)),
            "sal_psu": F.when(is_p, value(3)),
            "pressure_mbar": F.when(is_p & (n > 6), value(4)),
            "oxygen_mgl": F.when(is_p, late(5)),
            "ph": F.when(is_p, late(6)),
            "field_mask": F.when(is_p & (n == 8), truncated(value(7))),
            **{name: F.when(full, value(i + 1)) for i, name in enumerate(status)},
            "payload_raw": F.when(is_s & ~full, F.array_join(F.slice(f, 2, n), ",")),
        }
    )
    return out.drop("__f", "__r", "__x")


def parse_events(lines: DataFrame, line: str = "line") -> DataFrame:
    """Housekeeping lines of the events log; the receipt time is the record's time."""
    found = once(lines, "__line", F.col(line)).where(F.col("__line").rlike(BATTERY))
    fields = once(found, "__f", F.split(F.regexp_replace("__line", BATTERY, "$1\t$2\t$3\t$4"), "\t"))
    at = lambda i: F.get("__f", F.lit(i))
    values = F.struct(iso_timestamp(at(0)).alias("ts"), number(at(1)).alias("voltage_v"), number(at(2)).alias("current_a"), number(at(3)).alias("teensy_temp_c"))
    rows = once(fields, "__v", values).where(" AND ".join(f"__v.{c} IS NOT NULL" for c in ("ts", "voltage_v", "current_a", "teensy_temp_c")))
    return rows.select(*lines.columns, F.lit("SH").alias("tag"), "__v.*")


def typed_table(parsed: DataFrame, name: str) -> DataFrame:
    """One typed table out of the parsed lines; unknown tags are in none."""
    tag = {**{table: t for t, table in TABLE_OF.items()}, "system_health": "SH"}[name]
    columns = [c.split()[0] for c in TABLES[name].split(", ")]
    return parsed.where(F.col("tag") == tag).select(KEY, *columns, "chunk", "pos")


def read_log_tables(spark: SparkSession, root: str, staged: bool = False, ids: Sequence[str] | None = None) -> dict[str, DataFrame]:
    """The five typed tables of every deployment below the root, untrimmed.

    With ``staged`` the text is read and parsed once and written by tag; the tables then read their own
    columns of their own tag only.
    """
    parsed = parse_payload(payloads(scan_text(spark, root, ("gems", "surface"), ids))).where("tag IS NOT NULL")
    if staged:
        path = shared_dir(spark)
        narrow = parsed.drop("line", "payload", "receipt", "file_name")
        narrow.write.partitionBy("tag").parquet(path)
        parsed = spark.read.schema(narrow.schema).parquet(path)
    events = parse_events(scan_text(spark, root, ("events",), ids))
    tables = {name: typed_table(parsed, name) for name in ("rga", "valve", "scalup", "status")}
    tables["system_health"] = typed_table(events, "system_health")
    return tables
