import hashlib
import re
from itertools import permutations

import pytest

from loomsift.llm import audit

DOCS = "doc_id long, text string, lang string, source string"
LABELS = "doc_id long, quality int, toxic int"


def brute(docs, labels):
    """Every order applied to the rows one filter after the other."""
    none = 2**63
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    rows = []
    for doc_id, text, lang in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        key = none if doc_id is None else doc_id
        earlier = any((none if i is None else i) < key and (t or "") == text for i, t, _ in docs)
        failed = {
            "A": len(words) < 100,
            "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
            "D": bool(re.search("[#$%&*|]", text)),
            "E": earlier,
        }
        rows.append((lang or "", doc_id, {k for k, v in failed.items() if v}))
    out = {}
    for part in {r[0] for r in rows}:
        mine = [(i, f) for p, i, f in rows if p == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in map("".join, permutations("ABCDE")):
            left = mine
            for step, name in enumerate(order, 1):
                gone = [r for r in left if name in r[1]]
                left = [r for r in left if name not in r[1]]
                shapley[name] += len(gone)
                redundant = sum(name in f for _, f in mine) - len(gone)
                unique = sum(f == {name} for _, f in mine)
                out[part, order, step] = [len(left), len(gone), redundant, unique, sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone)]
        for (p, order, step), values in out.items():
            if p == part:
                values.append(shapley[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


def as_dict(df):
    rows = df.collect()
    found = {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in rows}
    assert len(found) == len(rows)
    return found


def test_query_against_brute_force(spark, sf_dir):
    docs = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    labels = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality", "toxic").collect()]
    assert as_dict(audit.op13_filter_audit(spark, sf_dir)) == brute(docs, labels)


def test_odd_rows(spark):
    """Nulls in every column, ties, repeated rows and labels, long texts, white space that no filter splits at."""
    long = " ".join(f"w{k}" for k in range(30_000))
    docs = [
        (1, None, "en"), (2, "", None), (3, "", ""), (None, "", "en"), (None, None, "en"), (4, long, "de"), (5, long, "en"), (5, long, "en"), (0, long, None),
        (6, "A B c", "de"), (7, "ÄÖÜ É", "de"), (8, "a\x0bb\x1fc " * 60, "fr"), (9, "AB " * 100, "fr"), (10, "a|b", "fr"), (11, "one " * 99, "fr"), (12, "one " * 100, "fr"),
        (13, " ".join(f"v{k % 80}" for k in range(100)), "fr"), (14, " ".join(f"v{k % 79}" for k in range(100)), "fr"), (15, "A23456789.", "fr"), (16, "A23456789", "fr"), (7, "ÄÖÜ É", "de"),
    ]
    labels = [(1, 1, None), (4, 1, 0), (4, 0, 1), (5, 1, 1), (None, 1, 1), (9, None, None), (99, 1, 1), (12, 1, 0), (12, 1, 0)]
    df = spark.createDataFrame([(*d, "x") for d in docs], DOCS).withColumnRenamed("source", "quality")
    assert as_dict(audit.filter_interactions(df, spark.createDataFrame(labels, LABELS))) == brute(docs, labels)


def test_empty(spark):
    none = audit.filter_interactions(spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS))
    assert none.collect() == []
    docs = [(1, "a b", "en")]
    assert as_dict(audit.filter_interactions(spark.createDataFrame([(*d, "") for d in docs], DOCS), spark.createDataFrame([], LABELS))) == brute(docs, [])


@pytest.mark.parametrize("copies", [500])
def test_hot_text_is_dealt_out(spark, copies):
    """Copies of one text meet their first by hash and doc_id: no join key has more than one of them."""
    docs = [(k, "same text", "en") for k in range(copies)]
    df = spark.createDataFrame([(*d, "") for d in docs], DOCS)
    found = as_dict(audit.filter_interactions(df, spark.createDataFrame([], LABELS)))
    assert found["en", "EABCD", 1][:3] == (1, copies - 1, 0)
    plan = audit.flagged(df, spark.createDataFrame([], LABELS))._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"Join LeftOuter, \(\(?h#\d+ = h#\d+\)? AND \(id#\d+L = id#\d+L\)\)", plan), plan
    assert hashlib.sha256(b"same text").digest_size == 32


def test_no_python_in_the_plan(spark, sf_dir):
    plan = audit.op13_filter_audit(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
