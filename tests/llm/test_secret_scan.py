import hashlib
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from topicweave.llm import secret_scan as ss

ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)


def brute_base(text):
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    names = ["assign", "access", "hex"]
    said = ",".join(f"{names[k]}:{s}:{e}" for s, k, e in sorted(spans))
    n = Counter(k for _, k, _ in spans)
    return n[0], n[1], n[2], hashlib.sha256(said.encode()).hexdigest()


def check(docs):
    rows = docs.select("doc_id", "text").collect()
    want = Counter((r.doc_id, *brute_base(r.text or "")) for r in rows)
    got = ss.document_report(docs, F.col("source"), F.struct("source", "lang")).collect()
    assert Counter((r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in got) == want
    return got


def secrets(spark):
    h = "0123456789abcdef" * 2
    texts = [
        f'é😀 PassWord = "{h}" and token:short secret: token:abcdefgh',
        "password=abcdef" * 3, "api_key='x.y=z-1/2+3' APIKEY:123456 api-key=123456",
        "AKIA" + "A" * 15 + " AKIA" + "B" * 16 + "xAKIAAKIA" + "C" * 30, h + "G" + h[:23] + " " + h * 20,
        "ſecret=longenough K token = = abcdef", "token=\n abcdef", "", None, "auth Zx81kQpL0mNvB7tR2sYe " + "QwErTy9087ZxCvBn4321+/aSdF" * 2,
        "bearer Zx81kQpL0mNvB7tR2sYe4" * 2,
    ]
    rows = [(i, t, "en", f"o{i}") for i, t in enumerate(texts)] + [(0, texts[0], "en", "o0")]
    shared = [(100 + i, "words auth Qw34ErTy56UiOp78AsDf here", "en", f"o{i}") for i in range(8)]
    return spark.createDataFrame(rows + shared, "doc_id long, text string, lang string, source string")


def test_base_spans_equal_brute_force(spark, sample, tricky):
    check(sample)
    check(tricky)
    check(secrets(spark))


def test_own_kinds_report_owner_specific_values_only(spark):
    got = defaultdict(list)
    for r in check(secrets(spark)):
        got[r.doc_id].append(r)
    assert "auth:" in got[9][0].spans and "blob:" in got[9][0].spans and got[9][0].n_live == 2
    for i in range(8):  # eight owners hold it: a copied example
        assert got[100 + i][0].spans == "" and got[100 + i][0].n_live == 0
    assert len(got[0]) == 2 and got[0][0] == got[0][1]


def test_ownership_counts(spark):
    rows = [(b"x", o, f"r{i % 3}") for i in range(30) for o in ("a", "b", None)] + [(b"y", "a", "r")]
    got = {bytes(r[0]): (r[1], r[2]) for r in ss.ownership(spark.createDataFrame(rows, "value_hash binary, owner string, repository string")).collect()}
    assert got == {b"x": (3, 9), b"y": (1, 1)}


def test_no_python_in_the_plan(spark, sample):
    plan = ss.document_report(sample, F.col("source"), F.col("lang"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_empty(spark, empty):
    assert ss.document_report(empty, F.col("source"), F.col("lang")).count() == 0


OWN = {
    "auth": (re.compile(r"\b(pwd|auth|credentials?|bearer)(?:[\"']?\x20*[:=]\x20*[\"']?|\x20)([A-Za-z0-9+/_.=-]{16,})".replace("(pwd|auth|credentials?|bearer)", "((?i:pwd|auth|credentials?|bearer))"), re.ASCII), 2, 16),
    "blob": (re.compile(r"(?<![A-Za-z0-9+/])[A-Za-z0-9+/]{40,}={0,2}"), 0, 40),
    "jwt": (re.compile(r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"), 0, 30),
}


def brute_report(rows):
    """Every span by hand: ownership over all rows, then the verdicts."""
    found = []
    for i, (doc_id, text, lang, source) in enumerate(rows):
        text = text or ""
        for m in ASSIGN.finditer(text):
            if len(m[2]) >= 6:
                found.append((i, 0, "assign", m.start(), m.end(), m[2]))
        for m in re.finditer("AKIA[A-Z0-9]+", text):
            if len(m[0]) >= 20:
                found.append((i, 1, "access", m.start(), m.end(), m[0]))
        for m in re.finditer("[0-9a-f]{24,}", text):
            found.append((i, 2, "hex", m.start(), m.end(), m[0]))
        for k, (name, (pattern, group, least)) in enumerate(OWN.items(), 3):
            for m in pattern.finditer(text):
                if len(m[group]) >= least:
                    found.append((i, k, name, m.start(), m.end(), m[group]))
    held = defaultdict(set)
    for i, *_, value in found:
        held[value].add((rows[i][3], rows[i][2]))
    spans, live, shared, copied = defaultdict(list), Counter(), Counter(), Counter()
    for i, k, name, s, e, value in found:
        owners, repos = len({o for o, _ in held[value]}), len(held[value])
        is_copied = owners > 2 or (owners > 1 and repos > 4)
        looks = not re.search(ss.PLACEHOLDER, value) and re.search("[0-9]", value) and len(set(value)) >= 8
        is_live = not is_copied and bool(looks)
        copied[i] += is_copied and (k < 3 or is_live)
        live[i] += is_live
        shared[i] += is_live and owners == 1 and repos > 1
        if k < 3 or is_live:
            spans[i].append((s, k, f"{name}:{s}:{e}"))
    return [(rows[i][0], ",".join(x[2] for x in sorted(spans[i])), live[i], shared[i], copied[i]) for i in range(len(rows))]


def spread_table(spark):
    """Values by how far they have spread: (owners, repositories of each)."""
    rows, n = [], 0
    for v, (owners, repos) in enumerate([(1, 1), (1, 6), (2, 1), (2, 2), (2, 3), (3, 1), (9, 2)]):
        value = f"Zx{v}kQpL0mNvB7tR2sYe4uW"
        for o in range(owners):
            for r in range(repos):
                rows.append((n, f"text auth={value} and token = {value}", f"repo{r}", f"owner{o}"))
                n += 1
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(3)


def test_all_spans_equal_brute_force(spark, sample, tricky):
    """The method's own kinds and verdicts as well as the base."""
    for docs in (sample, tricky.select("doc_id", "text", "lang", "source"), secrets(spark), spread_table(spark)):
        rows = [tuple(r) for r in docs.select("doc_id", "text", "lang", "source").collect()]
        got = ss.document_report(docs, F.col("source"), F.struct("source", "lang")).collect()
        assert len(got) == len(rows)
        assert {(r.doc_id, r.spans, r.n_live, r.n_shared, r.n_copied) for r in got} == set(brute_report(rows))


def test_shared_keys_are_told_apart_from_examples(spark):
    spans = ss.scan_secrets(spread_table(spark), F.col("source"), F.col("lang")).where("kind_name = 'assign'").collect()
    got = {(r.n_owners, r.n_repositories): (r.spread, r.live) for r in spans}
    assert got == {
        (1, 1): ("own", True), (1, 6): ("shared", True), (2, 2): ("own", True), (2, 4): ("own", True),
        (2, 6): ("copied", False), (3, 3): ("copied", False), (9, 18): ("copied", False),
    }


def test_hot_values_are_joined_apart(spark):
    docs = spread_table(spark)
    want = Counter(ss.document_report(docs, F.col("source"), F.col("lang")).collect())
    for hot in (0, 5):
        assert Counter(ss.document_report(docs, F.col("source"), F.col("lang"), hot=hot).collect()) == want
