"""Idempotent landing, the versioned log and the listing of real trees."""

import os
import threading

import pytest
from pyspark.sql import functions as F

from parcelflow.operators import export
from parcelflow.plans import adapters as A
from parcelflow.plans import catalog, fixtures
from parcelflow.sources.files import list_files
from parcelflow.sources.layers import read_published
from parcelflow.sources.log_store import LogStore
from parcelflow.streaming import incremental
from conftest import rows

# ---- landing -----------------------------------------------------------------


def _land(spark, tmp_path):
    return incremental.land_published(spark, str(tmp_path / "landing"), str(tmp_path / "store"), str(tmp_path / "ck"))


def _lots(tmp_path):
    root = tmp_path / "store" / "published"
    return {d: sorted(f for f in os.listdir(root / d) if f.endswith(".parquet")) for d in os.listdir(root) if d.startswith("lot=")}


def test_a_file_under_two_names_counts_once(spark, sf, tmp_path):
    landing = str(tmp_path / "landing")
    fixtures.land_layer_files(spark, sf, landing, ("communes", "sections"))
    out = _land(spark, tmp_path)
    want = sum(A.layer(spark, sf, n).count() for n in ("communes", "sections"))
    assert read_published(spark, out).count() == want
    fixtures.land_layer_files(spark, sf, landing, ("sections",))  # again, as a file of another name
    before = _lots(tmp_path)
    _land(spark, tmp_path)
    assert read_published(spark, out).count() == want and _lots(tmp_path) == before
    fixtures.land_layer_files(spark, sf, landing, ("lieux_dits",))
    fixtures.land_layer_files(spark, sf, landing, ("lieux_dits",))  # twice in one batch
    _land(spark, tmp_path)
    assert read_published(spark, out).count() == want + A.layer(spark, sf, "lieux_dits").count()


def test_only_touched_batches_are_rewritten_and_stay_sorted(spark, sf, tmp_path):
    landing = str(tmp_path / "landing")
    fixtures.land_layer_files(spark, sf, landing, ("parcelles", "communes"))
    out = _land(spark, tmp_path)
    before = _lots(tmp_path)
    A.layer(spark, sf, "sections").where("commune LIKE '59%'").write.mode("append").parquet(f"{landing}/layer=sections")
    _land(spark, tmp_path)
    after = _lots(tmp_path)
    assert {d for d in after if after[d] != before[d]} == {"lot=56_70"}
    pub = read_published(spark, out)
    keys = [F.col("departement"), F.col("commune"), export.type_prefix("type_objet"), F.col("section")]
    assert {r["n_out_of_order"] for r in catalog.out_of_order(pub.withColumn("part", F.col("lot")), keys).collect()} == {0}
    zones = export.read_zones(spark, out)
    assert zones.agg(F.sum("n")).first()[0] == pub.count()
    assert {(r["lot"], r["file"]) for r in zones.collect()} == {(d[4:], f) for d, fs in after.items() for f in fs}


@pytest.mark.parametrize("step", ["export_sorted", "write_zones"])
def test_a_failed_batch_is_run_again(spark, sf, tmp_path, monkeypatch, step):
    landing = str(tmp_path / "landing")
    fixtures.land_layer_files(spark, sf, landing, ("communes",))
    out = _land(spark, tmp_path)
    fixtures.land_layer_files(spark, sf, landing, ("sections", "communes"))

    def fails(*a, **k):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(incremental if step == "export_sorted" else export, step, fails)
        with pytest.raises(Exception, match="lost"):
            _land(spark, tmp_path)
    _land(spark, tmp_path)
    want = sum(A.layer(spark, sf, n).count() for n in ("communes", "sections"))
    assert read_published(spark, out).count() == want and export.read_zones(spark, out).agg(F.sum("n")).first()[0] == want


def test_equal_content_of_two_layers_is_not_one_file(spark, tmp_path):
    landing = str(tmp_path / "landing")
    for layer in ("feuilles", "sections"):
        spark.createDataFrame([("59350", "59350A")], "commune string, id string").write.parquet(f"{landing}/layer={layer}")
    spark.createDataFrame([("ZZ350", "x")], "commune string, id string").write.mode("append").parquet(f"{landing}/layer=sections")
    out = _land(spark, tmp_path)
    assert rows(read_published(spark, out), "type_objet", "id") == [("feuilles", "59350A"), ("sections", "59350A")]


# ---- log ---------------------------------------------------------------------


def _urls(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "url string")


def test_log_appends_only_what_is_new(spark, tmp_path):
    store = LogStore(spark, str(tmp_path / "log"))
    assert store.read().count() == 0 and store.versions() == []
    assert store.append(_urls(spark, "a", "b", "b", None)) == 1
    assert store.append(_urls(spark, "b", "c")) == 2 and store.append(_urls(spark, "a", "c")) == 2 and store.append(_urls(spark)) == 2
    assert rows(store.read()) == [("a",), ("b",), ("c",)] and rows(store.read(1)) == [("a",), ("b",)]
    first, second = store.segments()
    assert rows(store._read([second])) == [("c",)] and rows(store._read([first])) == [("a",), ("b",)]
    assert sorted(os.listdir(tmp_path / "log" / "segments")) == sorted([first, second])


def test_log_is_compacted_and_old_versions_stay_readable(spark, tmp_path):
    store = LogStore(spark, str(tmp_path / "log"), segments=3)
    for k in range(5):
        store.append(_urls(spark, f"u{k}"))
    assert len(store.segments()) <= 3 and store.read().count() == 5 and store.read(2).count() == 2
    assert store.vacuum() > 0 and store.read().count() == 5 and store.versions() == [store.versions()[-1]]
    with pytest.raises(ValueError):
        store.read(2)


def test_a_crash_leaves_the_old_version(spark, tmp_path, monkeypatch):
    store = LogStore(spark, str(tmp_path / "log"))
    store.append(_urls(spark, "a"))
    with monkeypatch.context() as m:
        m.setattr(LogStore, "_commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            store.append(_urls(spark, "b"))
    (tmp_path / "log" / "versions" / "_draft").write_text("half a ver")
    assert rows(store.read()) == [("a",)] and len(os.listdir(tmp_path / "log" / "segments")) == 2
    assert store.append(_urls(spark, "b")) == 2 and rows(store.read()) == [("a",), ("b",)]
    assert store.vacuum() == 1


def test_readers_see_whole_versions_while_one_writes(spark, tmp_path, monkeypatch):
    store, seen = LogStore(spark, str(tmp_path / "log")), []
    store.append(_urls(spark, "a"))
    commit = LogStore._commit

    def look(self, version, segments):
        seen.append(rows(LogStore(spark, self.root).read()))
        done = commit(self, version, segments)
        seen.append(rows(LogStore(spark, self.root).read()))
        return done

    monkeypatch.setattr(LogStore, "_commit", look)
    store.append(_urls(spark, "b"))
    assert seen == [[("a",)], [("a",), ("b",)]]


def test_two_writers_lose_nothing(spark, tmp_path, monkeypatch):
    """The second writer commits between the first one's reading and committing."""
    store, once = LogStore(spark, str(tmp_path / "log")), []
    store.append(_urls(spark, "a"))
    commit = LogStore._commit

    def late(self, version, segments):
        if not once:
            once.append(True)
            LogStore(spark, self.root).append(_urls(spark, "b", "c"))
        return commit(self, version, segments)

    monkeypatch.setattr(LogStore, "_commit", late)
    assert store.append(_urls(spark, "c", "d")) == 3
    assert rows(store.read()) == [("a",), ("b",), ("c",), ("d",)]
    monkeypatch.undo()
    threads = [threading.Thread(target=lambda k=k: LogStore(spark, store.root).append(_urls(spark, f"t{k}", "shared"))) for k in range(4)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    got = [r[0] for r in store.read().collect()]
    assert sorted(got) == ["a", "b", "c", "d", "shared", "t0", "t1", "t2", "t3"]


# ---- listing -----------------------------------------------------------------


def test_every_file_of_a_tree_is_listed(spark, tmp_path):
    names = ["a.shp", "deep/er/b.SHP", "deep/er/empty.shp", "deep/.hidden.shp", "deep/_x.shp", "with space/é=1/c%20.txt", "_folder/d.shp"]
    for n in names:
        p = tmp_path / "t" / n
        os.makedirs(p.parent, exist_ok=True)
        p.write_bytes(b"" if "empty" in n else n.encode())
        os.utime(p, (1_600_000_000, 1_600_000_000))
    os.makedirs(tmp_path / "t" / "nothing")
    got = list_files(spark, str(tmp_path / "t"))
    root = f"file:{tmp_path}/t/"
    want = sorted((n, 0 if "empty" in n else len(n.encode())) for n in names)
    assert sorted((r["path"].removeprefix(root), r["length"]) for r in got.collect()) == want
    assert {r[0] for r in got.select(F.unix_timestamp("modificationTime")).collect()} == {1_600_000_000}
    assert got.schema.simpleString() == "struct<path:string,length:bigint,modificationTime:timestamp>"
    assert list_files(spark, str(tmp_path / "t"), ".shp").count() == 6
    assert list_files(spark, str(tmp_path / "t" / "nothing")).count() == 0
