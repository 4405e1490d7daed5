"""Findings against Python's regular expressions; the ledger's increments; redaction."""
import random
import re

from pyspark.sql import functions as F

from starlake.llm import secrets

PATTERNS = [("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 6),
            ("access", "AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20), ("hex", "[0-9a-f]+", lambda m: len(m[0]) >= 24)]


def slow(text):
    found = [(m.start(), i, m.end(), k) for i, (k, p, ok) in enumerate(PATTERNS) for m in re.finditer(p, text or "", re.ASCII) if ok(m)]  # a long s is no s
    return sorted(found)


def texts():
    rnd = random.Random(5)
    parts = ["token", "=", ":", " ", '"', "'", "secret", "API_KEY", "apikey", "passwd", "abcdef", "abc", "AKIA", "ABCDEFGHIJKLMNOP", "0123456789abcdef",
             "deadbeefdeadbeefdeadbeef", "é", "日本", "\n", "==", "_.-", "PassWord", "ſecret", "😀"]
    made = ["".join(rnd.choices(parts, k=rnd.randint(1, 30))) for _ in range(300)]
    long = ("x " * 3000 + "token = abcdefgh ") * 60
    return dict(enumerate([None, "", *made, long, made[3], "a" * 100_000 + "!", "secret=token = abcdefgh", "token=secret=abcdefgh"]))


def test_findings_equal_python(docs_of):
    rows = texts()
    got = {r.doc_id: r.found for r in secrets.scan(docs_of(rows), rules=secrets.BASE).collect()}
    assert {d: [(x["start"], x["at"], x["end"], x["kind"]) for x in f] for d, f in got.items()} == {d: slow(t) for d, t in rows.items()}


def test_added_rules_and_ties(docs_of):
    text = "ghp_" + "a1B2" * 10 + "\n-----BEGIN RSA PRIVATE KEY-----\nMIIabc\n-----END RSA PRIVATE KEY-----"
    found = secrets.scan(docs_of([(1, text), (1, text), (None, text)])).collect()
    assert len(found) == 3
    assert all([x["kind"] for x in r.found] == ["bearer", "private_key"] for r in found)


def test_ledger_scans_only_unseen_pairs(spark, docs_of, tmp_path):
    ledger = str(tmp_path / "ledger")
    one = docs_of({1: "token = abcdefgh", 2: "token = abcdefgh", 3: "nothing"})
    assert secrets.update_ledger(one, "text", ledger, secrets.BASE[:1]).count() == 2  # two blobs
    assert secrets.update_ledger(one, "text", ledger, secrets.BASE[:1]).count() == 0
    two = docs_of({4: "nothing", 5: "new " + "a1" * 12})
    added = secrets.update_ledger(two, "text", ledger, secrets.BASE)
    by_size = sorted((len(r.rules), len(r.found)) for r in added.collect())
    assert by_size == [(2, 0), (3, 1)]  # the known blob lacks two rules, the new one all three
    raised = secrets.Rule("hex", 2, "[0-9a-f]{6,}")
    again = secrets.update_ledger(one.union(two), "text", ledger, (raised,))
    assert [set(r.rules) for r in again.collect()] == [{"hex@2"}] * 3
    found = {r.doc_id: [x["kind"] for x in r.found] for r in secrets.scan(one.union(two), ledger=ledger, rules=secrets.BASE).collect()}
    assert found == {1: ["assign"], 2: ["assign"], 3: [], 4: [], 5: ["hex"]}


def test_redaction_joins_overlaps(docs_of):
    text = "é token = deadbeefdeadbeefdeadbeef and AKIA" + "Z" * 16 + " end"
    rows = docs_of([(1, text), (2, None), (3, "clean"), (4, "")])
    got = {r.doc_id: r for r in secrets.redact(rows).collect()}
    assert got[1].text == "é [SECRET] and [SECRET] end"
    assert (got[2].text, got[3].text, got[4].text) == (None, "clean", "")
    assert secrets.redact(rows).columns == rows.columns
    clash = rows.selectExpr("doc_id", "text", "doc_id as _blob", "doc_id as _FOUND", "text as __found")
    kept = {r.doc_id: r for r in secrets.redact(clash).collect()}
    assert all(r._blob == r._FOUND == d for d, r in kept.items()) and kept[1].text == got[1].text and kept[1].__getitem__("__found") == text


def test_empty_table_and_native_plan(docs_of):
    assert secrets.scan(docs_of({})).collect() == []
    assert secrets.redact(docs_of({})).collect() == []
    plan = secrets.scan(docs_of({1: "x"})).select(F.size("found"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_known_versions_move_no_text(spark, docs_of, tmp_path):
    ledger = str(tmp_path / "ledger")
    docs = docs_of({k: f"token = abcdef{k % 20} " * 50 for k in range(60)})
    assert secrets.update_ledger(docs, "text", ledger).count() == 20
    hashes = secrets._hashes(docs, "text")
    assert secrets._todo(hashes, ledger, secrets.RULES).count() == 0
    for rows in (1_000_000, 0):  # looked up in place, or merged and joined
        got = secrets.unseen(docs, "text", hashes.selectExpr("blob", "array('x') as missing"), rows)
        assert got.count() == 20 and got.select("text").distinct().count() == 20
    plan = secrets.unseen(docs, "text", hashes.selectExpr("blob", "array('x') as missing"))._jdf.queryExecution().executedPlan().toString().splitlines()
    semi = next(i for i, x in enumerate(plan) if "BroadcastHashJoin" in x and "LeftSemi" in x)
    shuffles = [i for i, x in enumerate(plan) if "Exchange hashpartitioning(blob" in x]
    assert shuffles and max(shuffles) < semi  # texts are filtered before they are shuffled


def test_id_columns_named_like_results(docs_of):
    docs = docs_of({1: "token = abcdefgh", 2: None})
    for name in ("blob", "found"):
        got = secrets.scan(docs.select(F.col("doc_id").alias(name), "text"), id_col=name)
        assert got.columns[0] == name and len(set(got.columns)) == 3
        assert sorted((r[0], len(r[got.columns[2]])) for r in got.collect()) == [(1, 1), (2, 0)]
