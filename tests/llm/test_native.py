"""Mixing to weights and the secret ledger: brute force, odd rows, incremental scans."""

import hashlib
import re
from collections import Counter

import pytest

from medallion_ops.llm.mixing import mix_to_weights, mixed_documents
from medallion_ops.llm.secret_ledger import LEDGER_SCHEMA, RULES, Rule, scan_versions

from .odd import TEXTS, documents, empty

NO_PYTHON = ("Python", "Pandas", "Arrow")


def _targets(sizes, weights, budget, epochs):
    """Water-filling by repeated resharing: what is over a cap goes to the others by weight."""
    left, target, open_ = budget * sum(sizes.values()), {}, dict(zip(sizes, weights))
    while open_:
        w = sum(open_.values())
        over = [s for s in open_ if left * open_[s] / w >= epochs * sizes[s]]
        if not over:
            target |= {s: left * open_[s] / w for s in open_}
            break
        for s in over:
            target[s] = epochs * sizes[s]
            open_.pop(s)
        left -= sum(target[s] for s in over)
    return target


def test_mix_meets_its_targets(spark):
    rows = [(i, " ".join(["w"] * (1 + i * 7 % 13)), f"s{i % 5}" if i % 3 else "hot") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mix_to_weights(docs).collect()
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len(t.split())
    sizes = dict(sorted(sizes.items()))
    want = _targets(sizes, [(3, 1, 2)[i % 3] for i in range(len(sizes))], 1.5, 2)
    taken = Counter()
    for r in got:
        taken[r.source] += r.taken
        assert r.target == pytest.approx(want[r.source]) and r.source_size == sizes[r.source]
        assert r.taken in (0, r.size, 2 * r.size)
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 13          # the longest document
    again = {(r.doc_id, r.taken) for r in mix_to_weights(docs.repartition(7)).collect()}
    assert again == {(r.doc_id, r.taken) for r in got}


def test_mix_of_odd_rows_and_of_nothing(spark):
    got = mix_to_weights(documents(spark)).collect()
    assert len(got) == len(TEXTS)
    assert all(r.taken == 0 for r in got if r.size == 0) and {r.size for r in got if r.doc_id in (1, 2, 3)} == {0}
    everything = mix_to_weights(documents(spark), budget=9.0).collect()
    assert all(r.taken == 2 * r.size for r in everything)
    assert mix_to_weights(empty(spark)).count() == 0


def test_mixed_documents_repeat_rows_as_planned(spark):
    docs = documents(spark)
    plan = Counter()
    for r in mix_to_weights(docs).collect():
        plan[r.doc_id] += r.copies
    out = mixed_documents(docs)
    assert out.columns == docs.columns
    assert Counter(r.doc_id for r in out.collect()) == +plan
    assert mixed_documents(empty(spark)).count() == 0


def test_native_operators_run_no_python(spark):
    docs = documents(spark)
    for df in (mix_to_weights(docs), scan_versions(docs, path_col="doc_id")[0]):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in NO_PYTHON)


def _brute(text):
    found = []
    for place, rule in enumerate(RULES):
        pattern = {"access": r"AKIA[A-Z0-9]+", "hex": r"[0-9a-f]+"}.get(rule.kind, rule.pattern)
        for m in re.finditer(pattern, text or "", re.A):
            if len(m.group(rule.group)) >= rule.min_length:
                found.append((m.start(), place, m.end(), rule.kind))
    return [(k, b, e) for b, _, e, k in sorted(found)]


def test_secrets_match_brute_force(spark):
    texts = [t for _, t in TEXTS] + [
        "token=token:abcdefgh api-key='AAAAAA' Password : \"x1y2z3\" secret=abc", "AKIA" + "Z" * 15 + " AKIA" + "Z" * 16,
        "\U0001d573 " + "0123456789abcdef" * 3 + "\n" + "f" * 23 + " " + "f" * 24, "passwd=" + "AKIA" + "B" * 20 + "=deadbeef" * 4,
        "token=aaaaaa" * 50]
    docs = spark.createDataFrame(list(enumerate(texts)), "path long, text string")
    findings, _ = scan_versions(docs)
    got = {r.path: [(x["kind"], x["start"], x["end"]) for x in r.findings] for r in findings.collect()}
    assert got == {i: _brute(t) for i, t in enumerate(texts)}


def test_ledger_scans_only_unseen_blob_and_rule_version_pairs(spark):
    first = spark.createDataFrame([("a", "v1", "token=abcdef1"), ("b", "v1", "token=abcdef1"), ("c", "v1", "clean")],
                                  "path string, version string, text string")
    found, ledger = scan_versions(first, version_col="version")
    assert ledger.select("blob").distinct().count() == 2 and ledger.count() == 2 * len(RULES)
    assert spark.createDataFrame([], LEDGER_SCHEMA).columns == ledger.columns
    assert {(r.path, len(r.findings)) for r in found.collect()} == {("a", 1), ("b", 1), ("c", 0)}

    second = first.unionByName(spark.createDataFrame([("a", "v2", "clean"), ("d", "v1", "token=zzzzzz9")],
                                                     "path string, version string, text string"))
    found, added = scan_versions(second, ledger, version_col="version")
    assert {r.blob for r in added.collect()} == {hashlib.sha256(b"token=zzzzzz9").hexdigest()}
    assert {(r.path, r.version, len(r.findings)) for r in found.collect()} == {
        ("a", "v1", 1), ("b", "v1", 1), ("c", "v1", 0), ("a", "v2", 0), ("d", "v1", 1)}

    rules = (RULES[0], RULES[1], Rule("hex", r"[0-9a-f]{8,}", 8, version=2))          # one rule changed
    _, again = scan_versions(second, ledger.unionByName(added), rules, version_col="version")
    assert {r.kind for r in again.collect()} == {"hex"} and again.count() == 3


def test_secrets_of_odd_rows_and_of_nothing(spark):
    findings, added = scan_versions(documents(spark), path_col="doc_id")
    rows = findings.collect()
    assert len(rows) == len(TEXTS)
    assert {r.path for r in rows if r.findings} == {6, 9}
    assert added.select("blob").distinct().count() == len({t or "" for _, t in TEXTS})
    assert scan_versions(empty(spark), path_col="doc_id")[0].count() == 0


def test_same_path_with_other_texts(spark):
    docs = spark.createDataFrame([(1, "token=abcdef"), (1, "nothing"), (1, "token=abcdef")], "path long, text string")
    got = sorted(len(r.findings) for r in scan_versions(docs)[0].collect())
    assert got == [0, 1, 1]


def test_versions_without_a_path_meet_only_their_own_blob(spark, monkeypatch):
    """The blob is a key of the join that carries the texts: no pairs of rows that only share a path."""
    from medallion_ops.llm import secret_ledger

    plans, store = [], secret_ledger.materialize
    monkeypatch.setattr(secret_ledger, "materialize", lambda df, name: (plans.append(
        (name, df._jdf.queryExecution().optimizedPlan().toString())), store(df, name))[1])
    rows = [(None, f"token=abcdef{i}") for i in range(40)] + [(7, "token=zzzzzz1"), (7, "clean")]
    found, added = scan_versions(spark.createDataFrame(rows, "path long, text string"))
    assert sorted(len(r.findings) for r in found.collect()) == [0] + [1] * 41
    assert added.count() == 42 * len(RULES)
    joins = [line for name, plan in plans if name == "ledger" for line in plan.splitlines() if "Join Inner" in line]
    assert joins and all(re.search(r"blob#\d+ = blob#\d+", line) for line in joins)
