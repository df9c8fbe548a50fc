"""File-based operators on hand-written inputs in tests/data."""

import json
import os
import shutil
import tempfile

from pyspark.sql import functions as F

from conftest import DATA
from labelgraph.operators import ontology as O
from labelgraph.operators import qa as Q
from labelgraph.operators import samples as S
from labelgraph.sources import jsonl
from labelgraph.sources.images import list_images
from labelgraph.sources.meta import explode_entries, scan_meta_files
from labelgraph.sources.rdf import scan_rdfxml

NS = "urn:demo#"
PREDICATES = {
    "rdf:type": "ref",
    "rdfs:subClassOf": "ref",
    "rdfs:isDefinedBy": "literal",
    "rdfs:comment": "literal",
    "d:partOfArea": "ref",
    "d:partOfScope": "ref",
    "d:partOfAbility": "ref",
    "owl:onClass": "ref",
    "owl:qualifiedCardinality": "typed",
}


def triples(spark):
    return scan_rdfxml(spark, os.path.join(DATA, "onto.rdf"), PREDICATES, prefixes={"d": NS})


def test_triple_scan_shapes(spark):
    t = triples(spark)
    rows = t.collect()
    assert len(rows) == 27
    by = {(r.s, r.p): r for r in rows}
    card = by[("_:R1", "http://www.w3.org/2002/07/owl#qualifiedCardinality")]
    assert card.o == "1" and card.o_datatype.endswith("#nonNegativeInteger")
    d = by[(NS + "Counting", "http://www.w3.org/2000/01/rdf-schema#isDefinedBy")]
    assert d.o == "Saying number words in order & pointing\n   at objects, déjà vu."
    ws = by[(NS + "Circles", "http://www.w3.org/2000/01/rdf-schema#isDefinedBy")]
    assert ws.o == "   "


def test_discover_predicates(spark):
    from labelgraph.sources.rdf import discover_predicates

    assert discover_predicates(spark, os.path.join(DATA, "onto.rdf")) == PREDICATES


def test_triple_scan_missing_file(spark):
    t = scan_rdfxml(spark, os.path.join(DATA, "no-such-file.rdf"), PREDICATES)
    assert t.count() == 0 and t.columns == ["s", "p", "o", "o_kind", "o_datatype", "pos"]


def test_qa_from_rdf(spark):
    t = triples(spark)
    v = O.Vocab.for_namespace(NS)
    assert O.concepts(t, v).count() == 8
    dims = {r.iri.split("#")[1]: r.dim for r in O.concept_dim(t, v).collect()}
    assert dims["Money"] == "Area"
    fwd = {r.iri.split("#")[1]: r.output for r in Q.qa_forward(t, v).collect()}
    assert set(fwd) == {"Counting", "Shapes", "Circles", "Compare", "Money"}
    assert fwd["Circles"] == ""
    assert fwd["Shapes"] == "Flat figures and solids.\n\nEXAMPLE: a cube"
    assert fwd["Counting"].endswith("\n\nExample: counting apples\n\nExample: counting steps on a stair")
    rev = {r.iri.split("#")[1]: r for r in Q.qa_reverse(t, v).collect()}
    assert set(rev) == {"Counting", "Shapes", "Compare", "Money"}
    assert rev["Shapes"].instruction == "Flat figures and solids.\n\nExample: EXAMPLE: a cube"
    assert json.loads(rev["Money"].output) == {"Areas": ["Money"], "Scopes": [], "Abilities": []}
    assert Q.qa_def_label(t, v).count() == 4
    cp = {r.child.split("#")[1]: json.loads(r.output) for r in Q.qa_child_parent(t, v).collect()}
    assert cp["Compare"] == {"Areas": [], "Scopes": [], "Abilities": ["Observe"]}
    pc = Q.qa_parent_children(t, v).collect()
    assert len(pc) == 4
    assert Q.qa_full(t, v).count() == 4 + 3 + 4


def _tree(spark):
    root = os.path.join(DATA, "tree", "data")
    return scan_meta_files(spark, root), list_images(spark, root)


def test_meta_scan_and_images(spark):
    files, imgs = _tree(spark)
    paths = sorted(r.meta_path for r in files.collect())
    assert paths == ["data/w/sub/meta.json", "data/x/meta.json", "data/y/meta.json", "data/z/meta.json"]
    listed = sorted(r.path for r in imgs.collect())
    assert "data/img/7.png" in listed and len(listed) == 11  # any file counts, whatever its name
    assert list_images(spark, os.path.join(DATA, "tree", "data"), "*.png").count() == 6


def test_relative_root(spark):
    rel = os.path.relpath(os.path.join(DATA, "tree", "data"), os.getcwd())
    files, imgs = scan_meta_files(spark, rel), list_images(spark, rel)
    assert sorted(r.meta_path for r in files.collect())[0] == "data/w/sub/meta.json"
    assert "data/img/7.png" in {r.path for r in imgs.collect()}


def test_build_with_rejects(spark):
    files, imgs = _tree(spark)
    ex = explode_entries(files)
    ok = ex.where(F.col("file_reason").isNull()).select("meta_path", "pos", "entry")
    acc, rej = S.accept_and_reject(ex, imgs, from_valid_file=True)
    report = {r.reason: r.n for r in S.reject_report(S.outcomes(ex, imgs, from_valid_file=True)).collect()}
    assert report == {
        "accepted": 5,
        "bad_json": 1,
        "not_a_list": 1,
        "missing_field": 2,
        "image_not_found": 2,
        "bad_image": 1,
        "not_an_object": 1,
    }
    # accepted + rejected entries = all entries of decodable list files
    assert acc.count() + rej.where(F.col("pos").isNotNull()).count() == ok.count()
    got = {r.image: r.labels_json for r in acc.collect()}
    assert got["data/w/sub/pics/5.png"] == "null"
    assert "data/w/sub/../../img/7.png" in got
    ids = S.assign_ids(acc).orderBy("id").collect()
    assert [r.id for r in ids] == [f"sample_{i:06d}" for i in range(5)]
    assert [r.meta_path for r in ids] == sorted(r.meta_path for r in ids)


def test_empty_guard_and_jsonl(spark):
    files, imgs = _tree(spark)
    ex = explode_entries(files).where(F.col("file_reason").isNull()).select("meta_path", "pos", "entry")
    samples = S.training_samples(ex, imgs).select("id", "image", "conversations")
    out = tempfile.mkdtemp(prefix="lg-jsonl-")
    assert jsonl.write_jsonl(samples, out + "/samples") == 5
    back = jsonl.read_samples(spark, out + "/samples")
    assert back.count() == 5
    assert jsonl.write_jsonl(samples.limit(0), out + "/empty") == 0
    assert not os.path.exists(out + "/empty")


def test_annotation_shapes(spark):
    lines = spark.read.text(os.path.join(DATA, "annotations.jsonl"))
    got = {r.shape: r.answer for r in lines.select(S.annotation_shape("value").alias("shape"), S.normalise_annotation("value").alias("answer")).collect()}
    assert json.loads(got["object"]) == {"Scopes": ["Shapes"], "Abilities": ["Compare"]}
    assert json.loads(got["list"]) == {"Areas": ["Tally"]}


def test_stream_ingest_only_new_files(spark):
    from labelgraph.streaming.ingest import start_ingest

    work = tempfile.mkdtemp(prefix="lg-stream-")
    root = os.path.join(work, "data")
    shutil.copytree(os.path.join(DATA, "tree", "data", "x"), os.path.join(root, "x"))
    imgs = list_images(spark, os.path.join(DATA, "tree", "data"))
    out, ck = os.path.join(work, "out"), os.path.join(work, "ck")
    q = start_ingest(spark, root, imgs, out, ck)
    q.awaitTermination(120)
    first = spark.read.parquet(out + "/accepted")
    assert first.count() == 2
    os.makedirs(os.path.join(root, "w", "sub"))
    shutil.copy(os.path.join(DATA, "tree", "data", "w", "sub", "meta.json"), os.path.join(root, "w", "sub", "meta.json"))
    q = start_ingest(spark, root, imgs, out, ck)
    q.awaitTermination(120)
    acc = spark.read.parquet(out + "/accepted")
    per_batch = {r.batch_id: r.n for r in acc.groupBy("batch_id").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert sorted(per_batch.values()) == [2, 3]  # second run saw only the new file
    assert acc.select("id").distinct().count() == 5


def test_stream_ingest_waits_for_images(spark):
    from labelgraph.streaming.ingest import start_ingest

    work = tempfile.mkdtemp(prefix="lg-wait-")
    root, out = os.path.join(work, "data"), os.path.join(work, "out")
    os.makedirs(os.path.join(root, "a"))
    with open(os.path.join(root, "a", "meta.json"), "w") as f:
        f.write('[{"questionImage":"1.png","labels":1},{"questionImage":"2.png","labels":2}]')

    def images():
        return list_images(spark, root)

    start_ingest(spark, root, images, out, os.path.join(work, "ck")).awaitTermination(120)
    assert spark.read.parquet(out + "/accepted").count() == 0
    with open(os.path.join(root, "a", "2.png"), "w") as f:
        f.write("x")
    os.makedirs(os.path.join(root, "b"))
    with open(os.path.join(root, "b", "meta.json"), "w") as f:
        f.write("[")
    start_ingest(spark, root, images, out, os.path.join(work, "ck")).awaitTermination(120)
    assert [r.image for r in spark.read.parquet(out + "/accepted").collect()] == ["data/a/2.png"]
    assert spark.read.parquet(out + "/pending/batch_id=1").count() == 1
    assert [r.reason for r in spark.read.parquet(out + "/rejected").collect()] == ["bad_json"]


def test_odd_names_and_values(spark):
    """Folders with spaces and other characters, any image name, labels of any JSON type, repeated keys."""
    root = os.path.join(tempfile.mkdtemp(prefix="lg-odd-"), "data")
    entries = [
        {"questionImage": "2.PNG", "labels": {"Areas": []}},
        {"questionImage": "3.gif", "labels": "text label"},
        {"questionImage": "[5].png", "labels": ""},
        {"questionImage": "{6}.webp", "labels": 5},
        {"questionImage": ["2.PNG"], "labels": None},
        {"questionImage": 7, "labels": None},
    ]
    for folder in ("a b", "é+c%20", "plain"):
        os.makedirs(os.path.join(root, folder))
        for name in ("2.PNG", "3.gif", "[5].png", "{6}.webp"):
            open(os.path.join(root, folder, name), "w").write("x")
        body = json.dumps(entries)[:-1] + ', {"labels": 1, "questionImage": "no.png", "labels": {"x": 1}, "questionImage": "2.PNG"}]'
        with open(os.path.join(root, folder, "meta.json"), "w", encoding="utf-8") as f:
            f.write(body)
    ex = explode_entries(scan_meta_files(spark, root))
    rows = S.outcomes(ex, list_images(spark, root), from_valid_file=True).collect()
    by = {}
    for r in rows:
        by.setdefault(r.meta_path, {})[r.pos] = (r.outcome, r.labels_json)
    assert set(by) == {"data/a b/meta.json", "data/é+c%20/meta.json", "data/plain/meta.json"}
    for got in by.values():
        assert [got[i][0] for i in range(7)] == ["accepted"] * 4 + ["bad_image"] * 2 + ["accepted"]
        assert [got[i][1] for i in (0, 1, 2, 3, 6)] == ['{"Areas": []}', '"text label"', '""', "5", '{"x": 1}']


def test_rdf_scan_splits_one_file_and_keeps_all_predicates(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="lg-rdf-"), "big.rdf")
    with open(path, "w", encoding="utf-8") as f:
        f.write('<?xml version="1.0"?>\n<rdf:RDF xmlns:rdf="x" xmlns:z="y">\n')
        for i in range(4000):
            f.write(f'<rdf:Description rdf:about="urn:{i}"><z:label>a &lt; {i} > b</z:label><z:to rdf:resource=\'urn:x&amp;{i}\'/></rdf:Description>\n')
        f.write("</rdf:RDF>\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        t = scan_rdfxml(spark, path, prefixes={"z": "urn:z#"}, distinct=False)
        assert t.rdd.getNumPartitions() > 1
        assert t.count() == 8000
        row = t.where("s = 'urn:7' and o_kind = 'literal'").first()
        assert (row.p, row.o) == ("urn:z#label", "a < 7 > b")
        assert t.where("s = 'urn:7' and o_kind = 'iri'").first().o == "urn:x&7"
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_prompt_of_any_size(spark):
    from labelgraph.sources.prompt import read_prompt

    path = os.path.join(tempfile.mkdtemp(prefix="lg-prompt-"), "p.txt")
    with open(path, "w", encoding="utf-8") as f:
        f.write("é" * (1 << 20))
    assert len(read_prompt(spark, path)) == 1 << 20


def test_images_are_listed_by_tasks_as_binary_file_lists_them(spark, tmp_path, monkeypatch):
    from labelgraph.sources import images as I

    root = tmp_path / "img root"
    for name, text in (("a/1.png", "x"), ("a/b/é 2+%20.jpg", "xyz"), ("0.png", "xx"), ("a/empty.png", ""), ("_hid/3.png", "x"), (".hid/4.png", "x"), ("a/.5.png", "x"), ("a/_6.png", "x"), ("d=_7/_k=8.png", "x"), ("_k=1/9.png", "x"), ("_metadata/10.png", "x"), ("a/_metadata", "x"), ("a/11.png._COPYING_", "x")):
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_text(text)
    (tmp_path / "beside").mkdir()
    (tmp_path / "beside" / "12.png").write_text("x")
    (root / "link").symlink_to(tmp_path / "beside")

    def listed(*pattern):
        return sorted(tuple(r) for r in I.list_images(spark, str(root), *pattern).collect())

    patterns = [(), ("*.png",), ("[0-2]*",), ("{1,12}.png",), ("?.png",)]
    found = [listed(*p) for p in patterns]
    assert "FileScan binaryFile" not in I.list_images(spark, str(root))._jdf.queryExecution().executedPlan().toString()
    assert ("img root/link/12.png", 1) in found[0] and len(found[0]) == 7
    monkeypatch.setattr(I, "listable", lambda *a: False)
    assert found == [listed(*p) for p in patterns]


def test_a_stream_reads_many_small_files_in_few_tasks(spark, tmp_path):
    from labelgraph.session import OPEN_COST_CONF
    from labelgraph.streaming.ingest import meta_stream

    for i in range(400):
        (tmp_path / "in" / str(i)).mkdir(parents=True)
        (tmp_path / "in" / str(i) / "meta.json").write_text("[]")
    before = spark.conf.get(OPEN_COST_CONF)
    tasks = []
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16m")
    try:
        q = meta_stream(spark, str(tmp_path / "in")).writeStream.foreachBatch(lambda df, _: tasks.append((df.count(), df.rdd.getNumPartitions())))
        q.trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "state")).start().awaitTermination()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(tasks) == 1 and tasks[0][0] == 400 and tasks[0][1] <= 8  # 100 before: 4 files a task
    assert spark.conf.get(OPEN_COST_CONF) == before
