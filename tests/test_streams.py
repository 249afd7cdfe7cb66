from weekmart.sources import readers as r
from weekmart.sources.schemas import text
from weekmart.sources.snapshots import read_snapshot, versions
from weekmart.streaming import loads

SCHEMA = text("label", "sku", "lbs")


def deliver(folder, name, day, *rows, encoding="utf-8"):
    (folder / name).write_bytes(("label,sku," + day + " 11\n" + "".join(f"{r}\n" for r in rows)).encode(encoding))


def held(df):
    return sorted((x.label, x.sku, x.lbs, str(x.week_beginning_date)) for x in df.collect())


def test_dated_deliveries_stream_like_one_load(spark, tmp_path):
    folder, table, progress = tmp_path / "in", f"{tmp_path}/table", f"{tmp_path}/progress"
    folder.mkdir()

    def run(files_a_batch=1):
        loads.stream_shared(loads.arriving_files(spark, str(folder), files_a_batch=files_a_batch), table, progress, SCHEMA)

    deliver(folder, "a.csv", "2024-03-24", "x,1,5", '"two\nlines",2,6')
    deliver(folder, "b.csv", "2024-03-24", "y,3,7")  # the same week in another file
    deliver(folder, "c.csv", "2024-03-31", "Café,4,8", encoding="cp1252")
    run()
    assert versions(spark, table) == [1, 2, 3]
    assert held(read_snapshot(spark, table)) == held(r.read_shared(spark, str(folder), SCHEMA))
    deliver(folder, "d.csv", "2024-04-07", "z,5,9")
    run()  # goes on from its checkpoint
    assert versions(spark, table) == [1, 2, 3, 4]
    progress = f"{tmp_path}/progress-lost"
    run(2)  # all files once more
    assert held(read_snapshot(spark, table)) == held(r.read_shared(spark, str(folder), SCHEMA))
    assert len(held(read_snapshot(spark, table))) == 5


def test_a_batch_that_failed_is_repeated(spark, tmp_path, monkeypatch):
    folder, table, progress = tmp_path / "in", f"{tmp_path}/table", f"{tmp_path}/progress"
    folder.mkdir()
    deliver(folder, "a.csv", "2024-03-24", "x,1,5")
    replace, failed = loads.replace_partitions, []

    def fail_after(*args):
        replace(*args)
        if not failed:
            failed.append(1)
            raise RuntimeError("lost after the load")

    monkeypatch.setattr(loads, "replace_partitions", fail_after)
    for _ in range(2):
        try:
            loads.stream_shared(loads.arriving_files(spark, str(folder)), table, progress, SCHEMA)
        except Exception as error:
            assert "lost after the load" in str(error)
    assert failed and held(read_snapshot(spark, table)) == [("x", "1", "5", "2024-03-24")]
