"""Streams give what a batch run over the same bytes gives."""

from __future__ import annotations

import random
from pathlib import Path

import pytest
from conftest import HEADER, csv_line, raw_row

from txspark.plans.clean import clean, valid_rows
from txspark.plans.tables import receiver_order, region_risk, top_receivers
from txspark.schema import COLUMNS, RAW_SCHEMA
from txspark.sources.lines import read_transactions, stream_lines, stream_transactions
from txspark.streaming import live


def put(folder: str, number: int, data: bytes | str) -> None:
    data = data.encode() if isinstance(data, str) else data
    Path(folder, f"part_{number:03d}.csv").write_bytes(data)


def drain(df, out: str, checkpoint: str):
    """Process what is there and return the lines written so far."""
    query = df.writeStream.format("parquet").option("checkpointLocation", checkpoint)
    query.trigger(availableNow=True).start(out).awaitTermination()
    spark = df.sparkSession
    return sorted(r.value for r in spark.read.schema("value string").parquet(out).collect())


@pytest.fixture
def follow(spark, tmp_path):
    def run(folder, **options):
        lines = stream_lines(spark, folder, **options)
        return drain(lines, str(tmp_path / "out"), str(tmp_path / "checkpoint"))

    return run


def test_a_cut_record_waits_for_its_next_part(follow, parts_dir):
    folder = parts_dir("h\na1\nb")
    assert follow(folder) == ["a1"]
    assert follow(folder) == ["a1"]
    put(folder, 1, "2")
    assert follow(folder) == ["a1"]
    put(folder, 2, "2\nc3\nd")
    assert follow(folder) == ["a1", "b22", "c3"]
    assert follow(folder, flush="true") == ["a1", "b22", "c3", "d"]


def test_a_cut_header_is_never_data(follow, parts_dir):
    folder = parts_dir("head")
    assert follow(folder) == []
    put(folder, 1, "er")
    assert follow(folder) == []
    put(folder, 2, ",two\na\nb")
    assert follow(folder) == ["a"]
    put(folder, 3, "c\n")
    assert follow(folder) == ["a", "bc"]


def test_ranges_do_not_matter(follow, parts_dir):
    folder = parts_dir("h\n" + "".join(f"r{i:03d}\n" for i in range(50)))
    assert follow(folder, rangeBytes=7) == [f"r{i:03d}" for i in range(50)]


def test_bytes_after_a_flush_are_an_error(follow, parts_dir):
    folder = parts_dir("h\na")
    assert follow(folder, flush="true") == ["a"]
    put(folder, 1, "bc\n")
    with pytest.raises(Exception, match="flushed"):
        follow(folder)


def test_a_part_that_sorts_before_consumed_ones_is_an_error(follow, parts_dir):
    folder = parts_dir("h\na\n")
    put(folder, 5, "b\n")
    assert follow(folder) == ["a", "b"]
    put(folder, 3, "late\n")
    with pytest.raises(Exception, match="sorts before"):
        follow(folder)


def test_a_consumed_part_that_grew_is_an_error(follow, parts_dir):
    folder = parts_dir("h\na\n")
    assert follow(folder) == ["a"]
    put(folder, 0, "h\na\nb\n")
    with pytest.raises(Exception, match="has changed"):
        follow(folder)


def some_rows(seed: int, n: int) -> list[dict]:
    rng = random.Random(seed)
    return [
        raw_row(
            timestamp=1_700_000_000 + rng.randrange(40) * 3600,
            receiving_address=f"0x{rng.randrange(12):040x}",
            amount=rng.choice([None, 0.0, *[float(a) for a in range(1, 40)]]),
            transaction_type=rng.choice(["sale", "SALE ", "purchase", "phishing"]),
            location_region=rng.choice(["Asia", " Europe", "Africa", "9"]),
            risk_score=rng.randrange(100) + 0.5,
        )
        for _ in range(n)
    ]


@pytest.mark.parametrize("name", ["region_risk", "top_receivers"])
def test_tables_equal_the_batch_after_every_arrival(spark, parts_dir, tmp_path, name):
    batch, start = {
        "region_risk": (region_risk, live.start_region_risk),
        "top_receivers": (top_receivers, live.start_top_receivers),
    }[name]
    rows = some_rows(3, 150)
    data = "\n".join([HEADER, *map(csv_line, rows + rows[::7])]) + "\n"
    cut = [0, 4000, 9001, len(data)]
    folder = parts_dir(data[: cut[1]])
    table, checkpoint = str(tmp_path / "table"), str(tmp_path / "checkpoint")
    for i in range(1, len(cut)):
        put(folder, i - 1, data[cut[i - 1] : cut[i]])
        stream = clean(stream_transactions(spark, folder))
        start(stream, table, checkpoint, state_partitions=2).awaitTermination()
    got = {tuple(r) for r in live.read_table(spark, table).collect()}
    assert got == {tuple(r) for r in batch(clean(read_transactions(spark, folder))).collect()}
    assert len(got) >= 3


def test_late_rows_are_kept(spark, tmp_path):
    """Arrivals out of time order: after each, the stream holds what a batch would."""
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    days = [20, 3, 11, 3, 1, 20]
    rows = [raw_row(timestamp=1_700_000_000 + d * 86_400, login_frequency=i % 5) for i, d in enumerate(days)]
    for i in range(0, len(rows), 2):
        df = spark.createDataFrame([tuple(r[c] for c in COLUMNS) for r in rows[i : i + 2]], RAW_SCHEMA)
        df.write.mode("append").parquet(source)
        stream = clean(spark.readStream.schema(RAW_SCHEMA).parquet(source))
        with live.stream_settings(spark, 2):
            writer = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint)
            writer.trigger(availableNow=True).start(out).awaitTermination()
        got = spark.read.schema(stream.schema).parquet(out)
        expected = clean(spark.read.parquet(source))
        assert got.count() == expected.count()
        assert got.exceptAll(expected).isEmpty()


def test_fresh_checkpoint_takes_over(spark, parts_dir, tmp_path):
    """A query started anew over the same table is the newest from its first batch on."""
    table = str(tmp_path / "table")
    rows = some_rows(4, 60)
    lines = [HEADER, *map(csv_line, rows)]
    folder = parts_dir("\n".join(lines[:20]) + "\n")
    first = str(tmp_path / "first")
    for i, part in enumerate([None, "\n".join(lines[20:40]) + "\n", "\n".join(lines[40:]) + "\n"]):
        if part:
            put(folder, i, part)
        stream = clean(stream_transactions(spark, folder))
        live.start_region_risk(stream, table, first, state_partitions=2).awaitTermination()
    put(folder, 3, "\n".join(map(csv_line, some_rows(9, 30))) + "\n")
    stream = clean(stream_transactions(spark, folder))
    live.start_region_risk(stream, table, str(tmp_path / "second"), state_partitions=2).awaitTermination()
    got = {tuple(r) for r in live.read_table(spark, table).collect()}
    assert got == {tuple(r) for r in region_risk(clean(read_transactions(spark, folder))).collect()}
    assert len(list((tmp_path / "table").glob("version-*"))) <= live.KEPT_VERSIONS + 1


def test_limit_per_trigger(spark, parts_dir, tmp_path):
    rows = some_rows(8, 90)
    data = "\n".join([HEADER, *map(csv_line, rows)]) + "\n"
    folder = parts_dir(data[:5000], data[5000:])
    out = str(tmp_path / "out")
    stream = stream_transactions(spark, folder, maxBytesPerTrigger=3000)
    writer = stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c"))
    query = writer.trigger(processingTime="0 seconds").start(out)
    try:
        query.processAllAvailable()
        batches = [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]]
    finally:
        query.stop()
    got = spark.read.schema(stream.schema).parquet(out)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        map(tuple, read_transactions(spark, folder).collect()), key=str
    )
    assert len(batches) >= 3


def trial(parts_dir, tail=""):
    lines = [f"row{i:05d}" for i in range(2000)]
    data = "h\n" + "\n".join(lines) + "\n" + tail
    return parts_dir(data[:7001], data[7001:7003], data[7003:]), lines + ([tail] if tail else [])


def lines_in(spark, out):
    return sorted(r.value for r in spark.read.schema("value string").parquet(out).collect())


@pytest.mark.parametrize("bounded", [True, False])
@pytest.mark.parametrize("tail", ["", "tail"])
def test_a_limited_stream_is_drained_by_one_call(spark, parts_dir, tmp_path, bounded, tail):
    folder, lines = trial(parts_dir, tail)
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    stream = stream_lines(spark, folder, bounded=bounded, maxBytesPerTrigger=5000, flush=bool(tail))
    writer = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint)
    query = live.started(writer, out).awaitTermination()
    assert lines_in(spark, out) == lines
    sizes = [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]]
    assert len(sizes) >= 4 and max(sizes) <= 5000 // 9 + 1
    assert not query.isActive
    live.started(writer, out).awaitTermination()
    assert lines_in(spark, out) == lines


def test_the_end_of_a_bounded_run_is_fixed(spark, parts_dir, tmp_path):
    """Parts that arrive after the start are for the next run, on the same checkpoint."""
    folder, lines = trial(parts_dir)
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")

    def run(stream):
        writer = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint)
        live.started(writer, out).awaitTermination()
        return lines_in(spark, out)

    first = stream_lines(spark, folder, bounded=True, maxBytesPerTrigger=4000)
    put(folder, 3, "s1\ns2\ns")
    assert run(first) == lines
    put(folder, 4, "3\n")
    assert run(first) == lines
    assert run(stream_lines(spark, folder, bounded=True, maxBytesPerTrigger=4000)) == [*lines, "s1", "s2", "s3"]
    # an end that lies behind what is done changes nothing
    assert run(first) == [*lines, "s1", "s2", "s3"]
    put(folder, 2, "other\n")
    with pytest.raises(Exception, match="has changed"):
        run(stream_lines(spark, folder, bounded=True, maxBytesPerTrigger=4000))


def test_a_part_that_changes_after_the_end_was_fixed_is_an_error(spark, parts_dir, tmp_path):
    folder, _ = trial(parts_dir)
    stream = stream_lines(spark, folder, bounded=True)
    put(folder, 1, "xyz\n")
    writer = stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c"))
    with pytest.raises(Exception, match="has changed"):
        live.started(writer, str(tmp_path / "out")).awaitTermination()


def test_a_broken_off_run_goes_on(spark, parts_dir, tmp_path):
    """A run that fails between two batches leaves the rest to the next run: nothing twice."""
    folder, lines = trial(parts_dir, "tail")
    checkpoint, got = str(tmp_path / "checkpoint"), {}
    stream = stream_lines(spark, folder, bounded=True, maxBytesPerTrigger=3000, flush=True)

    def run(fails_at):
        def take(batch, number):
            if number == fails_at:
                raise RuntimeError("broken off")
            got[number] = [r.value for r in batch.collect()]

        writer = stream.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
        live.started(writer).awaitTermination()

    for fails_at in (0, 2, 5):
        with pytest.raises(Exception, match="broken off"):
            run(fails_at)
        assert len(got) == fails_at
    run(-1)
    assert sorted(x for rows in got.values() for x in rows) == lines


def day(d: int, amount: float, receiver: str) -> dict:
    return raw_row(timestamp=1_700_000_000 + d * 86_400, amount=amount, receiving_address=receiver, transaction_type="sale")


def arrive(spark, source: str, rows: list[dict]) -> None:
    df = spark.createDataFrame([tuple(r[c] for c in COLUMNS) for r in rows], RAW_SCHEMA)
    df.coalesce(1).write.mode("append").parquet(source)


def latest_by_hand(rows):
    """(day, amount) of each receiver's latest sale."""
    latest = {}
    for r in rows:
        if r["transaction_type"].strip().lower() == "sale" and (r["amount"] or 0) > 0 and r["location_region"] != "9":
            key, sale = r["receiving_address"], (r["timestamp"], r["amount"])
            latest[key] = max(sale, latest.get(key, sale))
    return latest


def test_a_batch_gets_changed_receivers_only(spark, tmp_path, monkeypatch):
    """Also where a leader falls and a receiver moves up that no batch has touched since."""
    source, table, checkpoint = (str(tmp_path / n) for n in ("in", "table", "checkpoint"))
    rng = random.Random(11)
    names = [f"0x{i:040x}" for i in range(30)]
    arrivals = [
        [day(10, 100.0 + i, n) for i, n in enumerate(names)],
        [day(9, 9000.0, names[3])],  # an older sale changes nothing
        [day(10, 129.0, names[29])],  # a copy neither
        [day(12, 1.0, names[29]), day(12, 2.0, names[28])],  # both leaders fall
        [day(11, 500.0, names[29]), day(13, 700.0, names[5])],
        *[[day(rng.randrange(25), float(rng.randrange(1, 300)), rng.choice(names)) for _ in range(12)] for _ in range(4)],
        [day(12, 1.0, names[29])],
    ]
    handed = []
    merge = live.Leaders.merge
    monkeypatch.setattr(live.Leaders, "merge", lambda self, changed, *rest: handed.append({r[0] for r in changed.collect()}) or merge(self, changed, *rest))
    seen: list[dict] = []
    for rows in arrivals:
        before = latest_by_hand(seen)
        arrive(spark, source, rows)
        seen += rows
        stream = valid_rows(spark.readStream.schema(RAW_SCHEMA).parquet(source))
        live.start_top_receivers(stream, table, checkpoint, buckets=4, state_partitions=2).awaitTermination()
        after = latest_by_hand(seen)
        assert handed.pop() == {k for k in after if after[k] != before.get(k)}
        best = sorted(((a, n) for n, (_, a) in after.items()), key=lambda x: (-x[0], x[1]))[:3]
        assert [(r["amount"], r["receiving_address"]) for r in live.read_table(spark, table).orderBy(*receiver_order()).collect()] == best
        held = {r["receiving_address"]: (int(r["timestamp"].timestamp()), r["amount"]) for r in live.read_latest_sales(spark, table).collect()}
        assert held == after
    state = tmp_path / "table" / "state"
    assert len(list((state / "manifests").glob("*.json"))) == 3
    assert len(list((state / "runs").iterdir())) < len(arrivals)  # runs merge, old ones go


def test_a_repeated_batch_leaves_the_same_table(spark, tmp_path, monkeypatch):
    """Broken off after the table, before the manifest; then again with all of it done."""
    source, table, checkpoint = (str(tmp_path / n) for n in ("in", "table", "checkpoint"))
    publish = live.Leaders.publish

    def run(broken):
        def fails(self, manifest):
            if broken == "after":
                publish(self, manifest)
            raise RuntimeError("broken off")

        monkeypatch.setattr(live.Leaders, "publish", fails if broken else publish)
        stream = valid_rows(spark.readStream.schema(RAW_SCHEMA).parquet(source))
        return live.start_top_receivers(stream, table, checkpoint, k=2, buckets=2, state_partitions=2).awaitTermination()

    rows = [day(1, 10.0 + i, f"0x{i:040x}") for i in range(6)]
    arrive(spark, source, rows)
    run(None)
    for broken, change in (("before", [day(2, 1.0, rows[5]["receiving_address"])]), ("after", [day(2, 2.0, rows[4]["receiving_address"])])):
        arrive(spark, source, change)
        rows += change
        with pytest.raises(Exception, match="broken off"):
            run(broken)
        run(None)
        best = sorted(((a, n) for n, (_, a) in latest_by_hand(rows).items()), key=lambda x: (-x[0], x[1]))[:2]
        assert [(r["amount"], r["receiving_address"]) for r in live.read_table(spark, table).orderBy(*receiver_order()).collect()] == best
    # another query's checkpoint does not fit this table
    with pytest.raises(Exception, match="does not hold batch"):
        live.Leaders(spark, f"{table}/state", 2, 2).merge(live.read_latest_sales(spark, table), 9, 99)


def test_a_fresh_checkpoint_forgets_the_receivers_of_an_older_query(spark, tmp_path):
    table = str(tmp_path / "table")
    for name, amount in (("one", 900.0), ("two", 5.0)):
        arrive(spark, str(tmp_path / name), [day(1, amount, f"0x{name}"), day(1, 3.0, "0xboth")])
        stream = valid_rows(spark.readStream.schema(RAW_SCHEMA).parquet(str(tmp_path / name)))
        live.start_top_receivers(stream, table, str(tmp_path / f"c{name}"), buckets=2, state_partitions=2).awaitTermination()
    assert {r["receiving_address"] for r in live.read_table(spark, table).collect()} == {"0xtwo", "0xboth"}
    assert {r["receiving_address"] for r in live.read_latest_sales(spark, table).collect()} == {"0xtwo", "0xboth"}
