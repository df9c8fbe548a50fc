"""``qa_full`` from one scan: equal to the parts built one by one."""

import random

from labelgraph.operators import ontology as O
from labelgraph.operators import qa as Q

V = O.Vocab.bare()


def graph(rng, n):
    rows = [("hub", "type", V.dim_classes[0]), ("_:blank", "type", V.dim_classes[1]), (V.dim_classes[0], "type", V.dim_classes[0])]
    for i in range(n):
        node = f"urn:c#n{i}"
        rows += [(node, "type", V.dim_classes[rng.randrange(3)]) for _ in range(rng.randrange(3))]
        rows += [(node, "isDefinedBy", rng.choice(["", "  ", " text ", "É “q”"])) for _ in range(rng.randrange(3))]
        rows += [(node, "comment", rng.choice(["", "note", " Example: x"])) for _ in range(rng.randrange(3))]
        rows += [(node, rng.choice(V.part_of), rng.choice(["hub", f"urn:c#n{rng.randrange(n)}"])) for _ in range(rng.randrange(3))]
        rows += [(node, "other", "x")]
    rows += [rows[-2]] * 2
    return [(s, p, o, "literal", rng.randrange(5)) for s, p, o in rows]


def test_qa_full_equals_its_parts(spark):
    t = spark.createDataFrame(graph(random.Random(2), 300), "s string, p string, o string, o_kind string, pos int").repartition(4)
    names = {"definition": (Q.qa_def_label, "iri"), "child_parent": (Q.qa_child_parent, "child"), "parent_children": (Q.qa_parent_children, "parent")}
    want = sorted((part, *r) for part, (fn, key) in names.items() for r in fn(t, V).select(key, "instruction", "output").collect())
    got = sorted(map(tuple, Q.qa_full(t, V).select("part", "key", "instruction", "output").collect()))
    assert got == want and {g[0] for g in got} == set(names)
    assert Q.qa_full(t.limit(0), V).count() == 0


def test_one_scan_and_one_shuffle(spark, tmp_path):
    t = spark.createDataFrame(graph(random.Random(3), 50), "s string, p string, o string, o_kind string, pos int")
    t.write.parquet(str(tmp_path / "t"))
    plan = Q.node_facts(spark.read.parquet(str(tmp_path / "t")), V)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and plan.count("Exchange hashpartitioning") == 1
