"""Counts, sizes, costs, ranges and listings."""

from pyspark.sql import functions as F

from tickloom.functions import times
from tickloom.operators import catalog, filters, formatting
from tickloom.plans import views
from tickloom.plans.registry import query
from tickloom.plans.views import sql
from tickloom.schemas import layout
from tickloom.session import shared_dir
from tickloom.sinks import export, files
from tickloom.sources import records
from tickloom.sources import venues as vn


def stored(spark, sf, stored_time=False):
    """Ticks with their dataset and schema names."""
    return views.ticks(spark, sf, stored_time).withColumn(
        "dataset", F.concat(F.lit("SET"), F.col("publisher_id").cast("string"))).withColumn(
        "schema", F.col("event_type"))


STORED = "stored AS (SELECT *, 'SET' || publisher_id AS dataset, event_type AS schema FROM ticks)"


@query("record_counts", sql("ticks", f""", {STORED} SELECT CAST(least(count(*), 1000) AS BIGINT) AS record_count FROM stored
  WHERE schema = 'click' AND ts_recv >= epoch_us(TIMESTAMP '2024-01-03') * 1000"""))
def record_counts(spark, sf):
    t = filters.time_range(stored(spark, sf, True).where(F.col("schema") == "click"), "2024-01-03", **views.STORED_TIME)
    return catalog.record_count(t, 1000)


def _sizes(spark, sf):
    """Record sizes per schema, one per event type of the stream."""
    kinds = views.table(spark, sf, "events").select("event_type").distinct()
    return kinds.select(F.col("event_type").alias("schema"), (F.length("event_type").cast("bigint") * 8).alias("record_bytes"))


def _unit_prices(spark, sf):
    s = stored(spark, sf).select("dataset", "schema").distinct()
    return s.select("dataset", "schema", F.explode(F.array(F.lit("historical"), F.lit("live"))).alias("mode")).withColumn(
        "unit_price", (F.length("schema") + F.length("mode")) / F.lit(2.0))


_SIZE = f"""{STORED}, sizes AS (SELECT dataset, schema, CAST(count(*) AS BIGINT) AS record_count,
  CAST(count(*) * length(schema) * 8 AS BIGINT) AS billable_size FROM stored GROUP BY 1, 2)"""


@query("billable_sizes", sql("ticks", f", {_SIZE} SELECT * FROM sizes"))
def billable_sizes(spark, sf):
    return catalog.billable_size(stored(spark, sf), _sizes(spark, sf))


@query("costs", sql("ticks", f""", {_SIZE} SELECT *, billable_size / 1e9 * ((length(schema) + 10) / 2.0::DOUBLE) AS cost
  FROM sizes"""))
def costs(spark, sf):
    return catalog.cost(billable_sizes(spark, sf), _unit_prices(spark, sf), "historical")


@query("unit_prices", sql("ticks", f""", {STORED} SELECT mode, string_agg(schema || '=' || CAST((length(schema) + length(mode)) / 2.0
  AS DECIMAL(9,1)), ',' ORDER BY schema) AS prices FROM (SELECT DISTINCT schema, unnest(['historical', 'live']) AS mode
  FROM stored WHERE dataset = 'SET1') GROUP BY 1"""))
def unit_prices(spark, sf):
    p = catalog.unit_prices(_unit_prices(spark, sf), "SET1")
    return p.select("mode", F.array_join(F.transform(F.array_sort(F.map_entries("unit_prices")), lambda e: F.concat(
        e["key"], F.lit("="), e["value"].cast("decimal(9,1)").cast("string"))), ",").alias("prices"))


@query("dataset_ranges", sql("ticks", f""", {STORED} SELECT dataset, schema, min(ts_recv) AS start_ns, max(ts_recv) AS end_ns
  FROM stored GROUP BY GROUPING SETS ((dataset), (dataset, schema))"""))
def dataset_ranges(spark, sf):
    return catalog.dataset_range(stored(spark, sf))


@query("dataset_conditions", sql("ticks", f""", {STORED}, c AS (SELECT DISTINCT dataset, CAST(d AS DATE) AS date FROM stored,
  (SELECT unnest(range(TIMESTAMP '2023-12-28', TIMESTAMP '2024-02-03', INTERVAL 1 DAY)) AS d)),
  n AS (SELECT dataset, CAST(make_timestamp(ts_recv // 1000) AS DATE) AS date, CAST(count(*) AS BIGINT) AS records,
  max(CASE WHEN flags & 4 <> 0 THEN 1 ELSE 0 END) AS bad FROM stored GROUP BY 1, 2)
  SELECT dataset, date, coalesce(records, 0) AS records, CASE WHEN records IS NULL THEN 'missing' WHEN bad = 1 THEN 'degraded'
  ELSE 'available' END AS condition FROM c LEFT JOIN n USING (dataset, date)"""))
def dataset_conditions(spark, sf):
    return catalog.dataset_condition(stored(spark, sf), "2023-12-28", "2024-02-02")


@query("dataset_list", sql("ticks", f""", {STORED} SELECT DISTINCT dataset FROM stored
  WHERE ts_recv >= epoch_us(TIMESTAMP '2024-01-05') * 1000 AND ts_recv < epoch_us(TIMESTAMP '2024-01-06') * 1000"""))
def dataset_list(spark, sf):
    return catalog.datasets(stored(spark, sf, True), "2024-01-05", "2024-01-06", **views.STORED_TIME)


@query("schema_list", sql("ticks", f", {STORED} SELECT DISTINCT schema FROM stored WHERE dataset = 'SET2'"))
def schema_list(spark, sf):
    return catalog.schemas_of(stored(spark, sf), "SET2")


@query("publisher_list", sql("venues", "SELECT publisher_id, name, dataset, venue, description FROM venues"))
def publisher_list(spark, sf):
    return catalog.publishers(views.venues(spark, sf))


_SHIPPED = ", ".join(f"({i}, '{n}', '{d.replace(chr(39), chr(39) * 2)}')" for i, n, d in vn.shipped_rows())


@query("publisher_names", sql("trades", f"""SELECT t.publisher_id, p.name, split_part(p.name, '.', 3) AS venue,
  split_part(p.name, '.', 1) || '.' || split_part(p.name, '.', 2) AS dataset, p.description, CAST(count(*) AS BIGINT) AS n
  FROM trades t LEFT JOIN (VALUES {_SHIPPED}) p(publisher_id, name, description) USING (publisher_id) GROUP BY ALL"""))
def publisher_names(spark, sf):
    """Trades by the feed that published them."""
    out = vn.add_publisher(views.trades(spark, sf), vn.known_publishers(spark))
    return out.groupBy("publisher_id", "name", "venue", "dataset", "description").agg(F.count(F.lit(1)).alias("n"))


@query("venue_ids", f"""SELECT venue, CAST(row_number() OVER (ORDER BY f) AS INTEGER) AS code FROM (SELECT split_part(name, '.', 3) AS venue,
  min(id) AS f FROM (VALUES {_SHIPPED}) p(id, name, description) WHERE id IN (SELECT l_suppkey % 142 + 1 FROM lineitem) GROUP BY 1)""")
def venue_ids(spark, sf):
    """Codes of the venues that the trades come from."""
    met = views.trades(spark, sf).select("publisher_id").distinct()
    return vn.code_table(vn.known_publishers(spark).join(met, "publisher_id", "left_semi"), "venue")


@query("publisher_lookup", sql("trades venues", """SELECT t.publisher_id, v.name, v.venue, v.dataset,
  CAST(count(*) AS BIGINT) AS n FROM trades t LEFT JOIN venues v USING (publisher_id) GROUP BY ALL"""))
def publisher_lookup(spark, sf):
    out = vn.add_publisher(views.trades(spark, sf), views.venues(spark, sf))
    return out.groupBy("publisher_id", "name", "venue", "dataset").agg(F.count(F.lit(1)).alias("n"))


@query("venue_codes", sql("venues", """SELECT venue, CAST(row_number() OVER (ORDER BY f) AS INTEGER) AS code FROM (
  SELECT venue, min(publisher_id) AS f FROM venues GROUP BY 1)"""))
def venue_codes(spark, sf):
    return vn.code_table(views.venues(spark, sf), "venue")


@query("metadata_check", sql("ticks", f""", {STORED}, f AS (SELECT dataset, schema, CAST(make_timestamp(ts_recv // 1000) AS DATE) AS start,
  max(flags) AS version, max(flags) > 200 AS ts_out FROM stored GROUP BY ALL)
  SELECT schema, CAST(count(*) AS BIGINT) AS files, concat_ws(',', CASE WHEN min(version) <> max(version) THEN 'version' END,
  CASE WHEN min(dataset) <> max(dataset) THEN 'dataset' END, CASE WHEN min(ts_out) <> max(ts_out) THEN 'ts_out' END) AS differing,
  false AS compatible FROM f GROUP BY 1"""))
def metadata_check(spark, sf):
    """A manifest with one entry per dataset, schema and day."""
    files = stored(spark, sf).groupBy("dataset", "schema", times.utc_date(F.col("ts_recv")).alias("start")).agg(
        F.max("flags").alias("version"), (F.max("flags") > 200).alias("ts_out"))
    out = catalog.metadata_differences(files, by=["schema"])
    return out.select("schema", "files", F.array_join("differing", ",").alias("differing"), "compatible")


@query("export_and_verify")
def export_and_verify(spark, sf):
    """Export the trades to the shared folder, list what was written, and check it."""
    path = shared_dir(spark, "export")
    t = views.ticks(spark, sf).where("rtype = 0").select(*[c for c in layout("trades").columns if c != "depth"])
    export.export(filters.time_range(t, "2024-01-01"), path, layout("trades"), split_duration="week", map_symbols=False)
    return export.verify(spark, export.manifest_of(spark, path), path)


def _fields_sql():
    rows = [(lay.name, i, f.name, f.dataType.simpleString()) for lay in map(layout, ("trades", "mbp-1")) for i, f in enumerate(lay.struct.fields)]
    return ", ".join(f"('{a}', {i}, '{b}', '{c}')" for a, i, b, c in rows)


@query("field_list", sql("ticks", f"""SELECT f.schema, CAST(position AS INTEGER) AS position, name, type, n AS records FROM (VALUES {_fields_sql()}) f(schema, position, name, type)
  JOIN (SELECT CASE rtype WHEN 0 THEN 'trades' WHEN 1 THEN 'mbp-1' END AS schema, CAST(count(*) AS BIGINT) AS n FROM ticks WHERE rtype IN (0, 1) GROUP BY 1) USING (schema)"""))
def field_list(spark, sf):
    """Fields of the schemas that the stored records have."""
    held = views.ticks(spark, sf).groupBy(F.when(F.col("rtype") == 0, "trades").when(F.col("rtype") == 1, "mbp-1").alias("schema")).agg(
        F.count(F.lit(1)).alias("records"))
    return catalog.fields(spark, [layout("trades"), layout("mbp-1")]).join(held, "schema")


CHUNKS = """chunks AS (SELECT sequence // 1000 AS chunk, string_agg(sequence || ',' || price || ',' || size || chr(10), '' ORDER BY sequence) AS body
  FROM ticks GROUP BY 1)"""


@query("verified_files", sql("ticks", f", {CHUNKS} SELECT chunk, CAST(strlen(body) AS BIGINT) AS size, sha256(body) AS digest, 'ok' AS status FROM chunks"))
def verified_files(spark, sf):
    """Files of a thousand records each against a manifest that is made from the records."""
    path = shared_dir(spark, "chunks")
    t = views.ticks(spark, sf).select(F.call_function("div", F.col("sequence"), F.lit(1000)).alias("chunk"), "sequence",
                                      F.concat_ws(",", "sequence", "price", "size").alias("value"))
    t.repartition("chunk").sortWithinPartitions("chunk", "sequence").drop("sequence").write.partitionBy("chunk").text(path)
    lines = F.transform(F.sort_array(F.collect_list(F.struct("sequence", "value"))), lambda r: F.concat(r["value"], F.lit("\n")))
    body = t.groupBy("chunk").agg(F.array_join(lines, "").alias("body"))  # at most a thousand records
    listed = export.manifest_of(spark, path).select("filename", F.regexp_extract("filename", r"chunk=(\d+)/", 1).cast("bigint").alias("chunk"))
    manifest = body.join(listed, "chunk", "left").select(
        F.coalesce("filename", F.concat(F.lit("chunk="), F.col("chunk").cast("string"))).alias("filename"), F.octet_length("body").cast("bigint").alias("size"),
        F.concat(F.lit("sha256:"), F.sha2("body", 256)).alias("hash"), "chunk")
    checked = export.verify(spark, manifest, path)
    return checked.join(manifest.select("filename", "chunk", F.substring_index("hash", ":", -1).alias("digest")), "filename", "left").select(
        "chunk", F.col("actual_size").alias("size"), "digest", "status")


@query("file_cuts", sql("ticks", """, s AS (SELECT publisher_id, ts_recv, sequence, size AS n, (SELECT max(size) FROM ticks) AS longest FROM ticks)
  SELECT sequence, publisher_id, CAST(coalesce(sum(n) OVER (PARTITION BY publisher_id ORDER BY ts_recv, sequence ROWS BETWEEN UNBOUNDED PRECEDING
  AND 1 PRECEDING), 0) // (1000 - longest) AS BIGINT) AS file FROM s"""))
def file_cuts(spark, sf):
    """In which file of at most 1,000 bytes each record of a publisher lies, where its size is its bytes."""
    t = views.ticks(spark, sf).select("publisher_id", "ts_recv", "sequence", "size")
    return export.file_numbers(t, ["publisher_id"], ["ts_recv", "sequence"], F.col("size"), 1_000).select("sequence", "publisher_id", "file")


@query("written_again", sql("ticks", "SELECT ts_recv, sequence, price, size FROM ticks WHERE rtype = 0"))
def written_again(spark, sf):
    """Compressed text that overwrites an earlier file and is read back."""
    path, lay = shared_dir(spark, "text"), layout("trades")
    t = views.ticks(spark, sf)
    for rtype in (1, 0):
        files.write_csv(t.where(F.col("rtype") == rtype), path, lay, False, False, compression="gzip", mode="w")
    return records.read_csv(spark, path, lay).select("ts_recv", "sequence", "price", "size")


@query("stamped_table", sql("ticks", """SELECT sequence, ts_recv // 1000 AS recv_us, (ts_recv + 1500) // 1000 AS out_us
  FROM ticks WHERE rtype = 0"""))
def stamped_table(spark, sf):
    """Records that carry the time at which they were sent on."""
    t = views.ticks(spark, sf).where("rtype = 0").select("ts_recv", "sequence", (F.col("ts_recv") + 1500).alias("ts_out"))
    shown = formatting.table(t)
    return shown.select("sequence", F.unix_micros("ts_recv").alias("recv_us"), F.unix_micros("ts_out").alias("out_us"))
