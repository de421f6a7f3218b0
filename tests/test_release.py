import gzip
import io
import json
import os
import shutil
import tarfile

import pytest

from millrace import release as R
from millrace.__main__ import main, progress_options
from millrace.sources.files import list_files, read_manifest
from millrace.streaming.ingest import current_version, ingest_stream
from millrace.streaming.progress import Progress, ProgressOptions, atomic_write, first_run, override_status

FACTS = {"nutriments": {"fat_100g": 1}}
LINES = [
    {"code": "11111111", "product_name": "a", **FACTS},
    {"code": "11111111", "product_name": "a", "brands": "b", "countries_tags": ["en:india"], "nutrition_data_per": "100g", **FACTS},
    {"code": "22222222", "product_name": "c", **FACTS},
    {"code": "123", "product_name": "d", **FACTS},
    {"code": "33333333", "product_name": "e", "nutriments": {}},
    "{malformed",
]


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("release")
    dump = folder / "dump.jsonl.gz"
    text = "\n".join(x if isinstance(x, str) else json.dumps(x) for x in LINES) + "\n"
    half = len(text) // 2
    dump.write_bytes(gzip.compress(text[:half].encode()) + gzip.compress(text[half:].encode()))  # two members
    out = io.StringIO()
    progress = Progress(ProgressOptions(1), out)
    with progress:
        m = R.build_release(spark, R.BuildOptions(str(dump), str(folder / "out"), "fixture_1.0", str(folder / "a.tar.zst"), chunk_size=1), progress)
    return folder, m, progress, out.getvalue()


def test_golden_counters(built):
    _, m, _, _ = built
    assert {k: m[k] for k in ("recordCount", "inputLines", "rawParsed", "acceptedProducts", "invalidLines", "skippedProducts", "sortRuns", "skippedInvalidBarcode", "skippedMissingNutrition")} == {
        "recordCount": 2, "inputLines": 6, "rawParsed": 5, "acceptedProducts": 3, "invalidLines": 1, "skippedProducts": 2, "sortRuns": 3, "skippedInvalidBarcode": 1, "skippedMissingNutrition": 1,
    }
    assert len(m) == 22


def test_winner_and_terms(spark, built):
    store = spark.read.parquet(f"{built[0]}/out/index")
    assert store.where("barcode = '11111111'").first()["brand"] == "b"
    assert store.where("array_contains(countries_index, 'india')").count() == 1
    assert len(store.columns) == 27


def test_phases_in_order(built):
    _, _, progress, text = built
    assert progress.phases == ["ingest", "external_sort", "merge", "index_commit", "hash", "manifest", "verify", "package", "complete"]
    assert all(len(line.split(" ")) == 20 for line in text.splitlines()) and "indexed_docs=2" in text


def test_archive(built, tmp_path):
    import zstandard

    with open(built[0] / "a.tar.zst", "rb") as f:
        tar = tarfile.open(fileobj=io.BytesIO(zstandard.ZstdDecompressor().stream_reader(f).read()))
    names = tar.getnames()
    assert names[-1] == "manifest.json" and names[:-1] == sorted(names[:-1]) and all(n.startswith("index/") for n in names[:-1])
    assert {(i.mode, i.mtime, i.uid, i.gid) for i in tar.getmembers()} == {(0o640, 0, 0, 0)}


def _copy(built, tmp_path):
    shutil.copytree(built[0] / "out", tmp_path / "r")
    return tmp_path / "r"


def _edit(root, **changes):
    m = json.loads((root / "manifest.json").read_text()) | changes
    (root / "manifest.json").write_text(json.dumps(m))


def _first(root):
    return root / read_manifest(f"{root}/manifest.json")["files"][0]["path"]


def test_untouched_copy_verifies(spark, built, tmp_path):
    root = _copy(built, tmp_path)
    (root / "index" / "extra").write_text("x")  # extra files are not looked for, but parquet readers would be
    (root / "index" / "extra").unlink()
    assert R.verify_release(spark, str(root))["recordCount"] == 2


@pytest.mark.parametrize("harm", ["byte", "missing", "path", "count", "version", "schema", "zero", "checksum", "manifest", "index", "hash"])
def test_verify_rejects(spark, built, tmp_path, harm):
    root = _copy(built, tmp_path)
    m = read_manifest(f"{root}/manifest.json")
    if harm == "byte":
        data = bytearray(_first(root).read_bytes())
        data[len(data) // 2] ^= 1
        _first(root).write_bytes(data)
        for crc in (root / "index").glob(".*.crc"):
            crc.unlink()
    elif harm == "missing":
        _first(root).unlink()
    elif harm == "path":
        _edit(root, files=[m["files"][0] | {"path": "../x"}, *m["files"][1:]])
    elif harm == "count":
        _edit(root, recordCount=3)
    elif harm == "version":
        _edit(root, datasetVersion="../x")
    elif harm == "schema":
        _edit(root, schemaVersion=2)
    elif harm == "zero":
        _edit(root, recordCount=0)
    elif harm == "checksum":
        _edit(root, indexSha256="0" * 64)
    elif harm == "manifest":
        (root / "manifest.json").write_text("{")
    elif harm == "index":
        shutil.rmtree(root / "index")
    else:
        _edit(root, inputSha256="xyz")
    with pytest.raises(R.InvalidRelease):
        R.verify_release(spark, str(root))


def test_all_rejected_fails(spark, tmp_path):
    (tmp_path / "d.gz").write_bytes(gzip.compress(b'{"code":"1"}\n'))
    with pytest.raises(R.InvalidRelease):
        R.build_release(spark, R.BuildOptions(str(tmp_path / "d.gz"), str(tmp_path / "o"), "v1"))


def test_trace(spark, built, tmp_path):
    dump = str(built[0] / "dump.jsonl.gz")
    R.build_release(spark, R.BuildOptions(dump, str(tmp_path / "o"), "v1", trace_barcode="22222222", trace_unit=""))
    for barcode, unit in (("22222222", "g"), ("99999999", "g"), ("33333333", "g")):
        with pytest.raises(R.InvalidRelease):
            R.build_release(spark, R.BuildOptions(dump, str(tmp_path / "o"), "v1", trace_barcode=barcode, trace_unit=unit))


@pytest.mark.parametrize("change", [{"chunk_size": 0}, {"worker_threads": 0}, {"index_memory": 1}, {"dataset_version": ""}, {"input": "/nowhere"}])
def test_option_checks(built, change):
    options = R.BuildOptions(str(built[0] / "dump.jsonl.gz"), "/tmp/x", "v1")
    for k, v in change.items():
        setattr(options, k, v)
    with pytest.raises(R.InvalidRelease):
        options.check()


def test_invalid_utf8_fails(spark, tmp_path):
    (tmp_path / "d.gz").write_bytes(gzip.compress(b'{"code":"\xff"}\n'))
    with pytest.raises(Exception, match="UTF-8"):
        R.build_release(spark, R.BuildOptions(str(tmp_path / "d.gz"), str(tmp_path / "o"), "v1"))


def test_listing(spark, tmp_path):
    (tmp_path / "r" / "index" / "b").mkdir(parents=True)
    (tmp_path / "r" / "index" / "b" / "x").write_text("1")
    (tmp_path / "r" / "index" / "a").write_text("22")
    (tmp_path / "r" / "index" / "w.lock").write_text("")
    found = [(r.path, r.bytes) for r in list_files(spark, str(tmp_path / "r" / "index")).collect()]
    assert found == [("index/a", 2), ("index/b/x", 1)]


def test_command_line_errors(tmp_path, capsys):
    assert main(["verify", "--release", str(tmp_path)]) == 1
    assert main(["help"]) == 0
    assert main(["verify", "--release", str(tmp_path), "--progress-interval-ms", "5", "--progress-interval-seconds", "5"]) == 1


def test_progress_rules():
    out = io.StringIO()
    p = Progress(ProgressOptions(10, 1000), out)
    p.update(records=9)
    assert out.getvalue() == ""
    p.update(records=10, input_lines=10)
    assert "input_lines=10" in out.getvalue()
    p.set_phase("a b/" + "x" * 60)
    assert p.phase == "a_b_" + "x" * 28
    with pytest.raises(ValueError):
        ProgressOptions(1, 0)


def test_status_helpers(tmp_path):
    atomic_write(str(tmp_path / "s"), "x")
    assert (tmp_path / "s").read_text() == "x" and os.listdir(tmp_path) == ["s"]
    assert json.loads(override_status('{"state": "running", "a": 1}', "t", "failure", 3)) == {"state": "failure", "a": 1, "timestamp": "t", "exitCode": 3}
    runs = [{"headSha": "a", "createdAt": "1"}, {"headSha": "a", "createdAt": "3"}, {"headSha": "a", "createdAt": "4"}]
    assert first_run(runs, "a", "2") == runs[1] and first_run(runs, "b", "0") is None


def test_stream_merges_batches(spark, tmp_path):
    (tmp_path / "in").mkdir()
    args = (str(tmp_path / "in"), str(tmp_path / "t"), str(tmp_path / "c"))
    for k, part in enumerate((LINES[:1], LINES[1:])):
        (tmp_path / "in" / f"{k}.jsonl").write_text("".join((x if isinstance(x, str) else json.dumps(x)) + "\n" for x in part))
        ingest_stream(spark, *args).awaitTermination(120)
    best = {r.barcode: r.brand for r in spark.read.parquet(current_version(args[1])).collect()}
    assert best == {"11111111": "b", "22222222": ""}


__all__ = ["progress_options"]
