"""Manifest planning, resume, logs, inventories and reachability."""

import json
import os
from collections import deque

from pyspark.sql import functions as F

from parcelflow.operators import inventory, links, manifest
from parcelflow.sources.files import list_files
from parcelflow.sources.manifest import read_log, read_manifest, write_log
from conftest import rows

TSV = ("format\tmillesime\tsource\n"
       "shp\t2025-04-01\thttps://x.example/shp/departements\n"
       "shp\t2025-01-01\thttps://x.example/shp/old/\n"
       "edigeo\t2025-04-01\thttps://x.example/edigeo/departements/\n"
       "shp\t2025-04-01\t   \n"
       "shp\t\thttps://x.example/shp/f.zip\n")


def test_manifest_outcomes_and_resume(spark, tmp_path):
    p = tmp_path / "m.tsv"
    p.write_text(TSV, encoding="utf-8")
    m = read_manifest(spark, str(p))
    log = spark.createDataFrame([("https://x.example/shp/old/",)], "url string")
    plan = manifest.plan_manifest(m, "shp", log)
    got = rows(plan, "source", "url", "outcome")
    assert got == [
        ("", None, "missing_url"),
        ("https://x.example/edigeo/departements/", "https://x.example/edigeo/departements/", "filtered"),
        ("https://x.example/shp/departements", "https://x.example/shp/departements/", "planned"),
        ("https://x.example/shp/f.zip", "https://x.example/shp/f.zip", "planned"),
        ("https://x.example/shp/old/", "https://x.example/shp/old/", "skipped"),
    ]
    assert rows(manifest.outcome_counts(plan)) == [("filtered", 1), ("missing_url", 1), ("planned", 2),
                                                   ("skipped", 1)]
    todo = manifest.resume_worklist(m, log, "shp")
    assert todo.count() == 2
    # resume twice: after logging what was done, nothing is left
    log2 = manifest.append_log(log, todo)
    assert manifest.resume_worklist(m, log2, "shp").count() == 0
    assert [r.format for r in manifest.manifest_formats(m).collect()] == ["edigeo", "shp"]


def test_manifest_without_format_column_ignores_filter(spark, tmp_path):
    p = tmp_path / "m.tsv"
    p.write_text("source\nhttps://x.example/a/\n", encoding="utf-8")
    plan = manifest.plan_manifest(read_manifest(spark, str(p)), "shp")
    assert rows(plan, "millesime", "outcome") == [("inconnu", "planned")]


def test_read_log_variants(spark, tmp_path):
    assert read_log(spark, str(tmp_path / "absent.json")).count() == 0
    good = tmp_path / "good.json"
    good.write_text(json.dumps({"downloaded_urls": ["https://a/1", "https://a/2"]}, indent=2))
    assert rows(read_log(spark, str(good))) == [("https://a/1",), ("https://a/2",)]
    bad = tmp_path / "bad.json"
    bad.write_text('{"downloaded_urls": ["https://a/1", ')
    assert read_log(spark, str(bad)).count() == 0
    files = spark.createDataFrame([("/m/h.example/a.zip", 5), ("/m/h.example/empty.zip", 0)], "path string, length long")
    for log in (bad, tmp_path / "absent.json"):
        assert rows(manifest.resume_log(spark, str(log), files, "/m")) == [("https://h.example/a.zip",)]
    assert rows(manifest.resume_log(spark, str(bad), files, "/m", str(tmp_path / "saved"))) == [("https://h.example/a.zip",)]
    assert rows(read_log(spark, str(tmp_path / "saved"), layout="lines")) == [("https://h.example/a.zip",)]
    assert manifest.resume_log(spark, str(good), files, "/m").count() == 2
    out = write_log(manifest.append_log(read_log(spark, str(good)),
                                        spark.createDataFrame([("https://a/2",), ("https://a/3",)], "url string")),
                    str(tmp_path / "v2"))
    assert rows(read_log(spark, out, layout="lines")) == [("https://a/1",), ("https://a/2",), ("https://a/3",)]


def test_file_inventory_on_real_listing(spark, tmp_path):
    files = {"d/01/cadastre-01-prefixes_sections.shp": b"x", "d/01/cadastre-01-sections.SHP": b"xy",
             "d/01/cadastre-01-sections.cpg": b"88591", "d/02/other.shp": b"z", "d/02/cadastre-02-parcelles.shp": b"",
             "d/02/cadastre-02-parcelles.parquet": b"p", "d/02/readme.txt": b"t"}
    for rel, data in files.items():
        os.makedirs(tmp_path / os.path.dirname(rel), exist_ok=True)
        (tmp_path / rel).write_bytes(data)
    listing = list_files(spark, str(tmp_path))
    assert sorted(os.path.basename(r.path) for r in list_files(spark, str(tmp_path), ".shp").collect()) == [
        "cadastre-01-prefixes_sections.shp", "cadastre-01-sections.SHP", "cadastre-02-parcelles.shp", "other.shp"]
    inv = inventory.classify_shapefiles(listing)
    # the empty parcelles.shp is listed too
    assert sorted(r.layer for r in inv.collect()) == ["parcelles", "prefixes_sections", "sections"]
    assert {r.ym for r in inv.collect()} == {inv.select(F.date_format(F.current_date(), "yyyy_MM")).first()[0]}
    missing = sorted(os.path.basename(r.path) for r in inventory.missing_sidecars(listing).collect())
    assert missing == ["cadastre-01-prefixes_sections.shp", "cadastre-02-parcelles.shp", "other.shp"]
    assert rows(inventory.sidecar_counts(listing)) == [(4, 3)]
    (tmp_path / "d/02/other.parquet").write_bytes(b"p")
    listing2 = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(str(tmp_path))
                .select("path", "length", "modificationTime"))
    plan = {os.path.basename(r.path): r.outcome for r in inventory.conversion_plan(listing2).collect()}
    assert plan == {"other.shp": "skipped", "cadastre-01-prefixes_sections.shp": "to_convert",
                    "cadastre-01-sections.SHP": "to_convert"}
    out = inventory.write_lists(listing, str(tmp_path / "lists"))
    ym_dirs = os.listdir(out)
    assert any(d.startswith("ym=") for d in ym_dirs)
    rebuilt = manifest.rebuild_log(listing, str(tmp_path))  # listing taken before the lists were written
    assert rows(rebuilt) and all(r[0].startswith("https://d/") for r in rows(rebuilt))
    assert rebuilt.count() == 6  # the empty file is not a finished download
    assert rows(rebuilt.where(F.col("url").contains("lists"))) == []


def test_reachable_matches_bfs_with_cycles(spark):
    edges = [(0, 1), (1, 2), (2, 0), (2, 3), (3, 4), (5, 6), (4, 4), (1, 4)]
    df = spark.createDataFrame(edges, "src long, dst long")
    got = dict(rows(links.reachable(df, spark.createDataFrame([(0,)], "node long")), "node", "depth"))
    adj, seen, q = {}, {0: 0}, deque([0])
    for s, d in edges:
        adj.setdefault(s, []).append(d)
    while q:
        n = q.popleft()
        for d in adj.get(n, []):
            if d not in seen:
                seen[d] = seen[n] + 1
                q.append(d)
    assert got == seen
    chain = spark.range(30).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst"))
    far = links.reachable(chain, spark.createDataFrame([(0,)], "node long"), merge_every=3)
    assert rows(far, "node", "depth") == sorted([(k, k) for k in range(31)], key=lambda t: tuple((True, str(x)) for x in t))


def test_crawl_follows_listings_only(spark):
    site = "https://h.example/"
    pages = spark.createDataFrame([
        (site, '<a href="../">up</a><a href="d/">d</a><a href="a.zip">a</a><a href="plain">p</a>'),
        (site + "d/", f'<a href="/">top</a><a href="../">up</a><a href="b.zip">b</a><a href="missing/">m</a><a href="{site}">x</a><a href="/d/">self</a>'),
        (site + "note", "no listing"),
        (site + "empty/", "<p>nothing</p>"),
    ], "url string, html string")
    seeds = spark.createDataFrame([(site,), (site + "note",), (site + "empty/",), (site + "lost.zip",)], "url string")
    got = rows(links.crawl(pages, seeds), "file", "folder", "depth")
    assert got == sorted([(site + "a.zip", site, 1), (site + "plain", site, 1), (site + "d/b.zip", site + "d/", 2), (site + "note", site, 0),
                          (site + "empty/", site + "empty/", 0), (site + "lost.zip", site, 0)], key=lambda t: tuple((True, str(x)) for x in t))


def test_conversion_outcomes_keep_every_failure(spark):
    plan = spark.createDataFrame([("a", "skipped"), ("b", "to_convert"), ("c", "to_convert"), ("d", "to_convert"), ("e", "to_convert")], "path string, outcome string")
    tried = spark.createDataFrame([("b", True, None), ("c", False, "bad"), ("d", False, "worse")], "path string, ok boolean, message string")
    got = inventory.conversion_results(plan, tried)
    assert rows(inventory.conversion_counts(got)) == [("failed", 2), ("skipped", 1), ("success", 1), ("to_convert", 1)]
    assert rows(inventory.conversion_failures(got)) == [("c", "bad"), ("d", "worse")]


def test_a_file_tried_again_has_one_outcome(spark):
    plan = spark.createDataFrame([("a", "to_convert"), ("b", "to_convert"), ("b", "to_convert"), ("c", "to_convert"), ("d", "to_convert")], "path string, outcome string")
    tried = spark.createDataFrame([("a", False, "bad", 1), ("a", True, None, 2), ("b", True, None, 1), ("b", False, "late", 3), ("c", False, "x", 5), ("c", False, "y", 5), ("d", None, "?", 1)], "path string, ok boolean, message string, at int")
    assert rows(inventory.conversion_results(plan, tried)) == [("a", "success", None), ("b", "failed", "late"), ("c", "failed", "y"), ("d", "failed", "?")]
    assert rows(inventory.conversion_results(plan, tried.drop("at"))) == [("a", "success", None), ("b", "success", None), ("c", "failed", "y"), ("d", "failed", "?")]


def test_blank_vintage_stays_blank(spark, tmp_path):
    p = tmp_path / "m.tsv"
    p.write_text("format\tmillesime\tsource\nshp\t\thttps://x.example/a/\n", encoding="utf-8")
    assert rows(manifest.clean_manifest(read_manifest(spark, str(p))), "millesime") == [("",)]


def test_seed_outcomes_directory_is_neither_and_failures_block_done(spark):
    res = spark.createDataFrame([("s1", "success"), ("s1", "directory"), ("s2", "success"), ("s2", "failure"),
                                 ("s3", "directory")], "seed string, outcome string")
    got = rows(manifest.seed_outcomes(res), "seed", "n_success", "n_failure", "n_directory", "done")
    assert got == [("s1", 1, 0, 1, True), ("s2", 1, 1, 0, False), ("s3", 0, 0, 1, True)]
