import json
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from session_data import CLOCK, SESSION, raw_trade
from tapeworks import schemas
from tapeworks.operators import staging
from tapeworks.plans import marts
from tapeworks.sources import raw as sources
from tapeworks.sources import sinks

NOON = CLOCK.replace(tzinfo=None)


def raw(spark, rows):
    return spark.createDataFrame(rows, schemas.RAW["trades"])


def facts(spark, rows):
    return staging.with_taker_side(staging.stage_trades(raw(spark, rows)))


def test_raw_scan_is_bounded(spark, tmp_path):
    path = str(tmp_path / "raw")
    sinks.append_strict(raw(spark, [raw_trade(1, 0), raw_trade(2, -10 * 86400), raw_trade(3, 0, publish_time=None)]), path, "trades")
    assert {r.trade_id for r in sources.scan_raw(spark, path, "trades", NOON).collect()} == {1, 3}
    assert sources.scan_raw(spark, path, "trades", NOON, days=None).count() == 3
    with pytest.raises(sinks.ContractError):
        sinks.append_strict(raw(spark, [raw_trade(1, 0)]).withColumn("extra", F.lit(1)), path, "trades")


def test_lake_round_trip(spark, tmp_path):
    path, rows = str(tmp_path / "lake"), raw(spark, [raw_trade(1, 0), raw_trade(2, 86400)])
    body = rows.select(F.to_json(F.struct(*schemas.TRADES.names)).alias("body"), "message_id", "publish_time")
    sinks.write_lake(body, path, "s")
    back = sources.scan_lake(spark, path, "trades", "2026-05-04", "2026-05-04")
    assert [r.trade_id for r in back.collect()] == [1]
    both = sources.scan_lake(spark, path, "trades", "2026-05-01", "2026-05-09")
    assert staging.stage_trades(both).exceptAll(staging.stage_trades(rows)).count() == 0


def test_dead_letters(spark):
    lines = spark.createDataFrame([('{"product_id":"P","trade_id":1,"price":"1"}',), ("{broken",), ('{"trade_id":2}',)], "value string")
    good, bad = sinks.split_valid(lines, schemas.TRADES, ("product_id", "price"))
    assert [r.trade_id for r in good.collect()] == [1]
    assert sorted(r.reason for r in bad.collect()) == ["field missing", "not parsed"]


def test_incremental_writes_are_idempotent(spark, tmp_path):
    path = str(tmp_path / "fct_trades")
    rows = [raw_trade(i, (i - 6) * 86400) for i in range(7)]
    sinks.write_incremental(facts(spark, rows), path, NOON, None, "fct_trades")
    assert spark.read.parquet(path).count() == 7
    sinks.write_incremental(facts(spark, [raw_trade(6, 0), raw_trade(60, 0), raw_trade(1, -5 * 86400, price="77")]), path, NOON, 3, "fct_trades")
    sinks.write_incremental(facts(spark, [raw_trade(6, 0), raw_trade(60, 0), raw_trade(1, -5 * 86400, price="77")]), path, NOON, 3, "fct_trades")
    back = spark.read.parquet(path)
    assert back.count() == 8 and back.where("price = 77").count() == 0
    with pytest.raises(sinks.ContractError):
        sinks.write_incremental(facts(spark, rows).withColumn("more", F.lit(1)), path, NOON, 3)


def test_contract(spark, tmp_path):
    df, path = facts(spark, [raw_trade(1, 0)]), str(tmp_path / "t")
    sinks.write_incremental(df, path, NOON, 3, "fct_trades")
    # the write itself fails, and what was there stays
    with pytest.raises(sinks.ContractError, match="nulls in side"):
        sinks.write_incremental(facts(spark, [raw_trade(1, 0, side=None)]), path, NOON, 3, "fct_trades")
    assert [r.side for r in spark.read.parquet(path).collect()] == ["buy"]
    with pytest.raises(sinks.ContractError, match="schema"):
        sinks.check_contract(df.withColumn("price", F.col("price").cast("double")), "fct_trades")


def test_marts_run_twice(spark, tmp_path):
    rows = [raw_trade(i, 60 * i, price=str(100 + i % 3), product=p, message_id=f"{p}{i}") for i in range(1, 40) for p in ("BTC-USD", "ETH-USD", "SOL-USD")]
    dim = sources.inline_products(spark)
    counts = marts.run({"trades_raw": raw(spark, rows)}, str(tmp_path), NOON + timedelta(hours=1), dim_products=dim)
    again = marts.run({"trades_raw": raw(spark, rows)}, str(tmp_path), NOON + timedelta(hours=1), dim_products=dim)
    assert counts == again and not any(counts.values()) and {"all_products_present", "products_are_known", "size_is_positive"} <= set(counts)
    assert spark.read.parquet(f"{tmp_path}/marts/fct_trades").count() == 117
    lazy = marts.build(raw(spark, rows))
    for name in ("fct_bars_5m", "fct_realized_vol"):
        stored = spark.read.parquet(f"{tmp_path}/marts/{name}").select(*lazy[name].columns)
        assert lazy[name].exceptAll(stored).count() == 0 and stored.count() == lazy[name].count()
    assert marts.run({"trades_raw": raw(spark, rows[:1])}, str(tmp_path / "one"), NOON + timedelta(hours=1))["all_products_present"] == 2


def test_bad_data_stops_the_run_before_what_is_built_on_it(spark, tmp_path):
    broken = [raw_trade(1, -86400), raw_trade(9, -86400)]
    with pytest.raises(ValueError, match="contiguous.* on fct_trades"):
        marts.run({"trades_raw": raw(spark, broken)}, str(tmp_path), NOON)
    assert (tmp_path / "marts" / "fct_trades").exists() and not (tmp_path / "marts" / "fct_bars_1m").exists()
    with pytest.raises(ValueError, match="products_are_known"):
        marts.run({"trades_raw": raw(spark, [raw_trade(1, 0)])}, str(tmp_path / "b"), NOON, dim_products=sources.inline_products(spark, ("ETH-USD",)))


def test_session_file_and_products(spark, tmp_path):
    (tmp_path / "s.jsonl").write_text("\n".join(json.dumps(m) for m in SESSION) + "\n")
    read = sources.read_session(spark, str(tmp_path / "s.jsonl"), NOON)
    assert [r.type for r in read.orderBy("line_no").collect()] == [m["type"] for m in SESSION]
    (tmp_path / "p.csv").write_text("product_id,base_currency,quote_currency,quote_increment,base_min_size,display_name\nX-USD,X,USD,0.01,0.001,X/USD\n")
    assert sources.read_products(spark, str(tmp_path / "p.csv")).schema["quote_increment"].dataType == schemas.NUM
    assert sources.inline_products(spark).count() == 3


def test_paged_source(spark):
    from tapeworks.operators.backfill import repair_rows, wanted_ids

    def fetch(before):
        return [{"trade_id": i, "price": "1", "size": "1", "side": "buy", "time": "2026-05-04T09:30:00Z"} for i in range(before - 1, max(before - 4, 0), -1)]

    spark.dataSource.register(sources.paged_trades(fetch))
    pages = spark.read.format("paged_trades").option("after", 5).option("before", 15).load()
    assert sorted(r.trade_id for r in pages.collect()) == list(range(6, 15))
    assert repair_rows(pages, wanted_ids(spark, 7, 10), "P", NOON).count() == 2


def test_paths_and_retention():
    assert sinks.layer_path("/r", "marts", "prod") == "/r/marts" and sinks.layer_path("/r", "marts", "ci") == "/r/ci"
    days = [date(2026, 5, d) for d in (1, 2, 20)]
    assert sinks.expired_days(days, date(2026, 5, 20), 14) == days[:2]


def test_expired_days_go(spark, tmp_path):
    rows = spark.createDataFrame([(i, date(2026, 5, d)) for i, d in enumerate((1, 2, 18, 20))], "id int, event_date date")
    path, cold = str(tmp_path / "t"), str(tmp_path / "cold")
    rows.write.partitionBy("event_date").parquet(path)
    assert sinks.expire(spark, path, date(2026, 5, 20), 18, archive=cold) == [date(2026, 5, 1)]
    assert sinks.expire(spark, path, date(2026, 5, 20), 14) == [date(2026, 5, 2)]
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [2, 3] and spark.read.parquet(cold).first().id == 0
    assert sinks.expire(spark, path, date(2026, 5, 20), 14) == [] == sinks.expire(spark, str(tmp_path / "none"), date(2026, 5, 20), 1)


def test_quarantine(spark, tmp_path):
    lines = spark.createDataFrame([('{"product_id":"P","trade_id":1}', 1), ("{broken", 1), ('{"product_id":"P","trade_id":2}', 6)], "value string, attempt int")
    good = sinks.quarantine(lines, str(tmp_path / "dead"), schemas.TRADES, ("product_id",))
    assert [r.trade_id for r in good.collect()] == [1]
    assert sorted(r.reason for r in spark.read.parquet(str(tmp_path / "dead")).collect()) == ["attempts spent", "not parsed"]


def test_avro_lake_round_trip(spark, tmp_path):
    from tapeworks.sources import avro

    rows = raw(spark, [raw_trade(i, 40 * i) for i in range(30)] + [raw_trade(99, 86400)])
    body = rows.select(F.lit("s").alias("subscription_name"), "message_id", "publish_time", F.encode(F.to_json(F.struct(*schemas.TRADES.names)), "UTF-8").alias("data")).coalesce(1)
    files = avro.write_envelopes(body, f"file://{tmp_path}/lake")
    # one file each 300 seconds of messages, and none over a day's end
    assert len(files) == 5 and files[0].endswith("dt=2026-05-04/09_30_00_00000_00000.avro")
    one = sources.scan_avro_lake(spark, f"file://{tmp_path}/lake", "trades", "2026-05-04", "2026-05-04")
    assert sorted(r.trade_id for r in one.collect()) == list(range(30))
    both = sources.scan_avro_lake(spark, f"file://{tmp_path}/lake", "trades", "2026-05-01", "2026-05-09")
    assert staging.stage_trades(both).exceptAll(staging.stage_trades(rows)).count() == 0
    small = avro.write_envelopes(body, f"file://{tmp_path}/small", most_bytes=2000, most_seconds=10**6)
    assert len(small) > 3


def test_avro_container():
    from tapeworks.sources import avro

    made = [("s", f"m{i}é", (-1) ** i * 10**i, bytes([i % 256]) * (i * 37), {"k": str(i)} if i % 2 else {}) for i in range(0, 16)] * 200
    for codec in ("null", "deflate"):
        c = avro.Container(codec)
        for m in made:
            c.add(*m)
        data = c.bytes()
        back = [tuple(e[k] for k in ("subscription_name", "message_id", "publish_time", "data", "attributes")) for e in avro.records(data)]
        assert back == made
        with pytest.raises(EOFError):
            list(avro.records(data[:-20]))
    with pytest.raises(ValueError, match="not an Avro"):
        list(avro.records(b"PAR1" + data))
    # a union, as other writers make them
    r = avro.Reader(bytes([2, 6]) + b"abc")
    assert r.value(["null", "string"]) == "abc" and avro.Reader(bytes([0])).value(["null", "string"]) is None


def test_bus_is_read_once_over_restarts(spark, tmp_path):
    held = [{"product_id": "P", "trade_id": i, "price": "1"} for i in range(25)]
    spark.dataSource.register(sources.bus(lambda a, b: [{"product_id": "P", "trade_id": i, "price": "1"} for i in range(a, min(b, 25))]))
    for _ in range(2):
        stream = spark.readStream.format("bus_trades").option("most", 10).load()
        query = stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "ck")).start()
        query.processAllAvailable()
        query.stop()
    assert sorted(r.trade_id for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [m["trade_id"] for m in held]


def test_command_lines(spark, tmp_path):
    from tapeworks import cli

    table = str(tmp_path / "raw")
    sinks.append_strict(raw(spark, [raw_trade(i, i) for i in (5, 6, 9, 14)]), table, "trades")
    args = cli.parser().parse_args(["backfill", "--endpoint", "http://x", "--product", "BTC-USD", "--table", table, "--parts", "3"])

    def fetch(before):
        return [{"trade_id": i, "price": "1", "size": "1", "side": "buy", "time": "2026-05-04T09:30:00Z"} for i in range(before - 1, max(before - 4, 0), -1) if i != 11]

    dry = cli.parser().parse_args(["backfill", "--endpoint", "http://x", "--product", "BTC-USD", "--table", table, "--dry-run"])
    assert cli.run_backfill(spark, dry) == 6 and cli.run_backfill(spark, args, fetch, CLOCK) == 5
    back = spark.read.parquet(table)
    assert sorted(r.trade_id for r in back.where("sequence = 0").collect()) == [7, 8, 10, 12, 13] and cli.run_backfill(spark, args, fetch, CLOCK) == 0
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text("\n".join(json.dumps({"product_id": "P", "trade_id": i, "price": "2", "size": "1", "event_time": (NOON + timedelta(seconds=20 * i)).isoformat() + "Z"}) for i in range(8)))
    run = cli.parser().parse_args(["bars", "--input", str(tmp_path / "in"), "--output", str(tmp_path / "bars"), "--checkpoint", str(tmp_path / "ck"), "--drain", "--allowed-lateness-seconds", "5"])
    cli.run_bars(spark, run)
    assert sorted(r.trade_count for r in spark.read.schema(schemas.BARS_STREAM).parquet(str(tmp_path / "bars")).collect()) == [3, 3]


def test_a_page_is_asked_for_by_its_address():
    import io

    asked = []

    def open_url(request):
        asked.append(request.full_url)
        return io.BytesIO(b'[{"trade_id": 4}]')

    assert sources.fetch_page("https://api.example/", "BTC-USD", 5, 100, open_url) == [{"trade_id": 4}]
    assert asked == ["https://api.example/products/BTC-USD/trades?limit=100&after=5"]


def test_lineage(spark):
    from tapeworks.plans.lineage import lineage

    empty = {"trades_raw": spark.createDataFrame([], schemas.RAW["trades"]), "l2_raw": spark.createDataFrame([], schemas.RAW["l2"]), "panes": spark.createDataFrame([], schemas.BARS_STREAM)}
    found = lineage(empty)
    assert found["trades_raw"].key == ("raw", "trades_stream") and found["int_book_state_1m"].group == "intermediate" and found["fct_bars_1m"].group == "marts"
    assert found["fct_stream_batch_recon"].upstream == (("raw", "bars_1m_stream"), ("fct_bars_1m",)) and found["fct_data_quality"].upstream == (("fct_trades",), ("raw", "trades_stream"))
