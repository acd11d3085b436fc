"""The same results in plain SQL, for checking the queries of ``suite``."""

E = "epoch_us(ts) / 1e6"
WORD = "CAST(event_id & 255 AS SMALLINT)"
HOUR = "floor(epoch_us(ts) / 1e6 / 3600) * 3600.0"
ARRIVAL = "row_number() OVER (ORDER BY event_id % 4, event_id) - 1"
POS = "row_number() OVER (ORDER BY ts, event_id) - 1"


def _field_stats(rows: list[tuple[str, str]], table: str, by: str = "") -> str:
    key, group = (f"{by}, ", f" GROUP BY {by}") if by else ("", "")
    return " UNION ALL ".join(
        f"SELECT {key}'{name}' AS field, count({x}) AS count, round(avg(CAST({x} AS DOUBLE)), 4) AS mean, "
        f"round(min(CAST({x} AS DOUBLE)), 6) AS min, round(max(CAST({x} AS DOUBLE)), 6) AS max FROM {table}{group}"
        for name, x in rows
    )


def _describe(table: str, names: list[str], digits: int) -> str:
    def one(x):
        stats = {
            "mean": f"avg({x})", "std": f"stddev_samp({x})", "min": f"min({x})", "p25": f"quantile_cont({x}, 0.25)",
            "p50": f"quantile_cont({x}, 0.5)", "p75": f"quantile_cont({x}, 0.75)", "max": f"max({x})",
        }
        cols = ", ".join(f"round({e}, {digits}) AS {n}" for n, e in stats.items())
        return f"SELECT '{x}' AS field, count({x}) AS count, {cols} FROM {table}"

    return " UNION ALL ".join(map(one, names))


def _running(over: str) -> str:
    w = f"OVER ({over} ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)"
    return (
        f"SELECT event_id, count(value) {w} AS count, round(avg(value) {w} + 1e-9, 6) AS mean, "
        f"min(value) {w} AS min, max(value) {w} AS max FROM events"
    )


def _range(rows: str) -> str:
    pad = "CASE WHEN lo <> hi THEN (hi - lo) * 0.05 WHEN lo = 0 THEN 1.0 ELSE abs(lo) * 0.05 END"
    return f"SELECT channel, lo - {pad} AS y_min, hi + {pad} AS y_max FROM ({rows})"


EVENT_COLUMNS = f"{E} AS \"TimeStamp\", event_id, user_id, event_type, value, {WORD} AS status"
EVENT_CHANNELS = [
    ("TimeStamp", E), ("event_id", "event_id"), ("user_id", "user_id"), ("value", "value"), ("status", WORD),
    ("tx", "event_id & 1"), ("rx", "(event_id >> 1) & 1"), ("errFlag", "(event_id >> 6) & 1"),
]
ELEMENTS = "SELECT vec_id, unnest(embedding) AS y, generate_subscripts(embedding, 1) - 1 AS index FROM embeddings"
LATEST = """
SELECT {cols}, total - rn AS seq FROM (
  SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY ts DESC, event_id DESC) AS rn,
         count(*) OVER (PARTITION BY {by}) AS total FROM events) WHERE rn <= {n}"""
STATUS = """
SELECT event_type, count(*) AS total_written, CAST(1500 AS BIGINT) AS capacity,
       least(count(*), 1500) AS size, count(*) - least(count(*), 1500) AS overwritten FROM events GROUP BY event_type"""
CURSORS = """
SELECT event_type, user_id, CASE WHEN user_id % 10 <> 0 THEN count(*) END AS cursor FROM events GROUP BY event_type, user_id"""
RUNNING_SUMMARY = """
SELECT event_type, count(value) AS count, round(avg(value) + 1e-9, 6) AS mean, min(value) AS min, max(value) AS max
FROM events GROUP BY event_type"""
HOURLY = """
SELECT floor(epoch_us(ts) / 1e6 / 3600) * 3600 AS "TimeStamp", count(*) AS count, round(count(*) / 3600.0::DOUBLE, 9) AS rate
FROM events GROUP BY 1"""
POSITIONS_BY_TYPE = """
SELECT event_id, event_type, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1 AS seq FROM events"""

ORACLES = {
    "batch_stats": f"""
SELECT batch, count(*) AS count, batch * 1000 + count(*) AS total, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std
FROM (SELECT value, ({POS}) // 1000 AS batch FROM events) GROUP BY batch""",
    "batch_stats_per_stream": f"""
SELECT event_type, batch, count(*) AS count, batch * 250 + count(*) AS total, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std
FROM (SELECT event_type, value, (row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1) // 250 AS batch FROM events)
GROUP BY event_type, batch""",
    "field_stats": _field_stats(
        [("TimeStamp", "(epoch_us(l_shipdate) / 1e6)")]
        + [(c, c) for c in ("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax")],
        "lineitem",
    ),
    "field_stats_per_stream": _field_stats(
        [("TimeStamp", f"({E})"), ("event_id", "event_id"), ("user_id", "user_id"), ("value", "value"), ("status", WORD)],
        "events", "event_type",
    ),
    "array_stats": _field_stats([("embedding", "y")], "(SELECT unnest(embedding) AS y FROM embeddings)")
    + " UNION ALL " + _field_stats([("label", "label")], "embeddings"),
    "describe_fields": _describe("lineitem", ["l_quantity", "l_extendedprice", "l_discount", "l_tax"], 4),
    "describe_value": _describe("events", ["value"], 6),
    "running_stats": _running("PARTITION BY user_id"),
    "running_stats_one_stream": _running(""),
    "running_stats_split_stream": _running("PARTITION BY event_type"),
    "running_summary": RUNNING_SUMMARY,
    "rate_per_hour": HOURLY,
    "rate_per_stream": """
SELECT event_type, floor(epoch_us(ts) / 1e6 / 86400) * 86400 AS "TimeStamp", count(*) AS count, round(count(*) / 86400.0::DOUBLE, 9) AS rate
FROM events GROUP BY 1, 2""",
    "visible_range": "SELECT channel, round(y_min, 3) AS y_min, round(y_max, 3) AS y_max FROM (" + _range(
        " UNION ALL ".join(
            f"SELECT '{n}' AS channel, min(CAST({x} AS DOUBLE)) AS lo, max(CAST({x} AS DOUBLE)) AS hi FROM events "
            f"WHERE {E} BETWEEN 1704300000 AND 1705900000"
            for n, x in EVENT_CHANNELS[:5]
        )
    ) + ")",
    "visible_array_range": "SELECT channel, round(y_min, 4) AS y_min, round(y_max, 4) AS y_max FROM (" + _range(
        f"SELECT 'embedding[' || index || ']' AS channel, min(CAST(y AS DOUBLE)) AS lo, max(CAST(y AS DOUBLE)) AS hi "
        f"FROM ({ELEMENTS}) WHERE vec_id >= 10 GROUP BY index "
        "UNION ALL SELECT 'label', min(CAST(label AS DOUBLE)), max(CAST(label AS DOUBLE)) FROM embeddings WHERE vec_id >= 10"
    ) + ")",
    "stream_status": STATUS,
    "consumer_lag": f"""
SELECT event_type, user_id, coalesce(cursor, -1) AS cursor, coalesce(total_written - cursor, -1) AS lag FROM ({CURSORS}) c JOIN ({STATUS}) s USING (event_type)""",
    "write_space": f"""
SELECT event_type, total_written - min(cursor) AS max_lag, greatest(1500 - (total_written - min(cursor)), 0) AS free
FROM ({STATUS}) JOIN ({CURSORS}) USING (event_type) GROUP BY event_type, total_written""",
    "record_positions": f"SELECT event_id, {POS} AS seq FROM events",
    "stream_positions": POSITIONS_BY_TYPE,
    "split_stream_positions": POSITIONS_BY_TYPE,
    "record_batches": f"SELECT event_id, ({POS}) // 1000 AS batch FROM events",
    "latest_global": f"""
SELECT event_id, {E} AS "TimeStamp", value, seq FROM (SELECT *, {POS} AS seq FROM events) ORDER BY ts DESC, event_id DESC LIMIT 2000""",
    "latest_per_stream": LATEST.format(cols="user_id, event_id, value", by="user_id", n=10),
    "latest_split_stream": LATEST.format(cols="event_type, event_id, value", by="event_type", n=100),
    "slice_records": f"SELECT event_id, value, seq FROM (SELECT *, {POS} AS seq FROM events) WHERE seq BETWEEN 1234 AND 2010",
    "read_after": f"SELECT event_id, value, seq FROM (SELECT *, {POS} AS seq FROM events) WHERE seq >= 2500",
    "read_after_per_stream": """
SELECT user_id, event_id, seq FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS seq FROM events) WHERE seq >= 5 AND seq < 25""",
    "text_positions": "SELECT event_id, props, row_number() OVER (ORDER BY props NULLS FIRST, event_id) - 1 AS seq FROM events",
    "head_records": f'SELECT event_id, {E} AS "TimeStamp", value FROM events ORDER BY ts, event_id LIMIT 100',
    "concat_records": f"""
SELECT {E} AS "TimeStamp", event_id AS id, value AS y FROM events
UNION ALL SELECT epoch_us(l_shipdate) / 1e6, l_orderkey, l_extendedprice FROM lineitem""",
    "select_fields": f'SELECT {E} AS "TimeStamp", value FROM events',
    "numeric_value": f"""
SELECT event_id, CAST(event_id AS DOUBLE) AS id_double, CAST(trunc(value) AS INTEGER) AS value_int32,
       CASE WHEN event_id BETWEEN 0 AND 255 THEN CAST(event_id AS SMALLINT) ELSE -1 END AS id_uint8, {WORD} AS status_int16 FROM events""",
    "set_value": "SELECT event_id, CAST(7 AS BIGINT) AS user_id, value * 2.0::DOUBLE + 1.0::DOUBLE AS value FROM events",
    "set_array_value": "SELECT vec_id, embedding[3] AS e2, CAST(0.5 AS FLOAT) AS e3 FROM embeddings",
    "clear_records": """
SELECT 0::DOUBLE AS "TimeStamp", 0::BIGINT AS event_id, 0::BIGINT AS user_id, '' AS event_type, 0::DOUBLE AS value,
       0::SMALLINT AS status FROM events""",
    "named_bits": """
SELECT event_id, (event_id & 1) = 1 AS tx, ((event_id >> 6) & 1) = 1 AS err, CAST((event_id >> 1) & 1 AS DOUBLE) AS rx_value FROM events""",
    "expand_bits": f"""
SELECT event_id, {WORD} AS status, CAST(event_id & 1 AS INTEGER) AS tx, CAST((event_id >> 1) & 1 AS INTEGER) AS rx,
       CAST((event_id >> 6) & 1 AS INTEGER) AS "errFlag" FROM events""",
    "set_bit": """
SELECT event_id, CAST(((event_id & 255 & ~3) | 64 | CASE WHEN value > 50 THEN 2 ELSE 0 END) AS SMALLINT) AS status FROM events""",
    "array_element": 'SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS "first", embedding[64] AS "last" FROM embeddings',
    "explode_elements": f"SELECT vec_id, CAST(index AS INTEGER) AS index, y FROM ({ELEMENTS})",
    "channels": " UNION ALL ".join(
        f"SELECT event_id, '{n}' AS channel, CAST({x} AS DOUBLE) AS y FROM events" for n, x in EVENT_CHANNELS
    ),
    "array_channels": f"""
SELECT vec_id, 'embedding[' || index || ']' AS channel, CAST(y AS DOUBLE) AS y FROM ({ELEMENTS})
UNION ALL SELECT vec_id, 'label', CAST(label AS DOUBLE) FROM embeddings""",
    "range_filter": f'SELECT event_id, {E} AS "TimeStamp", value FROM events WHERE {E} BETWEEN 1704300000 AND 1705900000',
    "catalog_fields": """
SELECT stream, CAST(pos AS INTEGER) AS pos, field, src_type, CAST(n AS INTEGER) AS count, CAST(n_bits AS INTEGER) AS n_bits, records
FROM (VALUES ('events', 0, 'TimeStamp', 'Double', 1, 0), ('events', 1, 'event_id', 'Int64', 1, 0),
             ('events', 2, 'user_id', 'Int64', 1, 0), ('events', 3, 'event_type', 'Char', 16, 0),
             ('events', 4, 'value', 'Double', 1, 0), ('events', 5, 'status', 'UInt8', 1, 3),
             ('vectors', 0, 'TimeStamp', 'Double', 1, 0), ('vectors', 1, 'vec_id', 'Int64', 1, 0),
             ('vectors', 2, 'embedding', 'Float', 64, 0), ('vectors', 3, 'label', 'Int32', 1, 0)
     ) AS f(stream, pos, field, src_type, n, n_bits)
JOIN (SELECT 'events' AS stream, count(*) AS records FROM events
      UNION ALL SELECT 'vectors', count(*) FROM embeddings) USING (stream)""",
    "publish_roundtrip": f"SELECT {EVENT_COLUMNS} FROM events",
    "arrival_positions": f'SELECT event_id, {HOUR} AS "TimeStamp", {ARRIVAL} AS position FROM events',
    "slice_published": f"""
SELECT event_id, value, position FROM (SELECT *, {ARRIVAL} AS position, count(*) OVER () AS n FROM events)
WHERE position >= n // 3 AND position < n // 3 + n // 4""",
    "published_between": f"""
SELECT event_id, "TimeStamp", position, row_number() OVER (ORDER BY "TimeStamp", position) - 1 AS seq
FROM (SELECT event_id, {HOUR} AS "TimeStamp", {ARRIVAL} AS position FROM events) WHERE "TimeStamp" BETWEEN 1704300000 AND 1705900000""",
    "binary_roundtrip": f"SELECT {EVENT_COLUMNS}, 'Events' AS alias FROM events",
    "array_roundtrip": f"SELECT vec_id, CAST(index AS INTEGER) AS index, y FROM ({ELEMENTS})",
    "sections_inventory": """
SELECT * FROM (
  SELECT 'Events' AS name, 'Header' AS type, 6 AS n_fields, 49 AS rec_size, 0::BIGINT AS n_records, 0::BIGINT AS data_bytes
  UNION ALL SELECT 'Events', 'Data', 6, 49, count(*), count(*) * 49 FROM events
  UNION ALL SELECT 'Vectors', 'Header', 4, 276, 0, 0
  UNION ALL SELECT 'Vectors', 'Data', 4, 276, count(*), count(*) * 276 FROM embeddings)""",
    "csv_roundtrip": f"""
SELECT {E} AS "TimeStamp", event_id, user_id, event_type, round(value, 6) AS value, {WORD} AS status FROM events""",
    "csv_text_roundtrip": """
SELECT event_id, '  a,"' || event_type || ''' \\ ," ' AS event_type FROM events""",
    "array_csv_roundtrip": f"""
SELECT vec_id, CAST(index AS INTEGER) AS index, true AS same FROM ({ELEMENTS})""",
    "whole_recording": "SELECT event_id, value FROM events",
    "rate_tenth": "SELECT event_id AS tenth, count(*) AS count FROM events GROUP BY event_id",
    "write_space_all_streams": """
WITH s AS (SELECT CASE WHEN event_type <> 'click' THEN event_type END AS stream, count(*) AS n FROM events GROUP BY 1)
SELECT coalesce(stream, '-') AS stream, n - n // 2 AS max_lag, greatest(1500 - (n - n // 2), 0) AS free FROM s
UNION ALL SELECT 'silent', 0, 1500""",
    "record_producer": """
SELECT CAST(event_id AS DOUBLE) AS "TimeStamp", event_id, event_id / 2.0::DOUBLE AS half FROM events WHERE event_id % 3 <> 0""",
    "snapshot_frame": "SELECT event_id, value FROM events ORDER BY ts DESC, event_id DESC LIMIT 2000",
    "live_consumer_lag": """
WITH n AS (SELECT count(*) AS a, count(*) FILTER (event_id % 4 < 2) AS h FROM events)
SELECT 'events' AS stream, 'slow' AS consumer, h AS cursor, a - h AS lag, h AS copied FROM n
UNION ALL SELECT 'events', 'quick', a, 0, a FROM n
UNION ALL SELECT 'events', 'onlooker', -1, -1, -1""",
    "stream_records": f"SELECT {EVENT_COLUMNS} FROM events",
    "record_to_both": f"""
SELECT 'binary' AS sink, event_id, value, {WORD} AS status FROM events
UNION ALL SELECT 'csv', event_id, round(value, 6), {WORD} FROM events""",
    "stream_recordings": f"SELECT {EVENT_COLUMNS} FROM events",
    "stream_followed": f"SELECT {EVENT_COLUMNS}, CAST(event_id % 3 AS INT) AS part FROM events",
    "stream_running_stats": RUNNING_SUMMARY,
    "stream_rate": HOURLY,
    "stream_latest": LATEST.format(cols="user_id, event_id, value", by="user_id", n=10),
    "stream_batch_stats": "SELECT count(*) AS count, round(avg(value), 6) AS mean, round(stddev_pop(value), 4) AS std FROM events",
    "stream_each_record": "SELECT event_id, value FROM events",
    "stream_progress": "SELECT count(*) AS records FROM events",
}
ORACLES["stream_running_records"] = ORACLES["running_stats"]
ORACLES["stream_to_recording"] = ORACLES["binary_roundtrip"]
ORACLES["recording_range"] = ORACLES["range_filter"]
ORACLES["stream_record_batches"] = ORACLES["batch_stats"]
