import hashlib
import re
from collections import Counter

from salesweft.llm import secret_scan
from tests.llm import cases

PATTERNS = [
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 24),
]
ROWS = [
    (1, "token=abc token=token:abcdefg"),
    (2, "😀 é password: 'hunter22' x" * 700),
    (3, 'Api_Key = "a.b/c==" AKIA' + "Z" * 16 + " " + "ab12" * 6),
    (3, 'Api_Key = "a.b/c==" AKIA' + "Z" * 16 + " " + "ab12" * 6),
    (None, "secret:\tabcdefgh Secret =abcdefgh"),
    (4, "AKIAAKIA" + "0" * 30),
    (5, "-----BEGIN RSA PRIVATE KEY----- ghp_" + "a1" * 20 + " xoxb-1234567890ab"),
    (6, "e" * 23 + "\n" + "e" * 24 + "g" + "f" * 60),
]


def brute(text):
    found, counts = [], []
    for k, (_, pattern, group, least) in enumerate(PATTERNS):
        spans = [(m.start(), k, m.end()) for m in pattern.finditer(text or "") if len(m[group]) >= least]
        found += spans
        counts.append(len(spans))
    joined = ",".join(f"{PATTERNS[k][0]}:{a}:{b}" for a, k, b in sorted(found))
    return (*counts, hashlib.sha256(joined.encode()).hexdigest()), joined


def test_base_spans_match_brute_force(spark):
    rows = ROWS + cases.texts()
    found = secret_scan.secret_counts(cases.documents(spark, rows)).collect()
    assert Counter((r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in found) == Counter((i, *brute(t)[0]) for i, t in rows)
    for r in found:
        base = ",".join(s for s in r.spans.split(",") if s.split(":")[0] in ("assign", "access", "hex"))
        assert hashlib.sha256(base.encode()).hexdigest() == r.base_sha256


def test_more_rules_add_spans(spark):
    found = {r.doc_id: r.spans for r in secret_scan.secret_counts(cases.documents(spark, ROWS)).collect()}
    assert found[5].startswith("private_key:0:31,code_host:32:76") and "chat:77:94" in found[5]


def test_only_base_rules_and_empty_table(spark):
    docs = cases.documents(spark, ROWS)
    found = secret_scan.secret_counts(docs, more_rules=[]).collect()
    assert Counter((r.doc_id, r.spans) for r in found) == Counter((i, brute(t)[1]) for i, t in ROWS)
    assert secret_scan.secret_counts(docs.limit(0)).count() == 0


def test_queries_follow_the_patterns():
    assert secret_scan.trigram_query(r"[0-9a-f]{24,}") == []
    assert secret_scan.trigram_query(r"AKIA[A-Z0-9]+") == [[frozenset({"aki", "kia"})]]
    strings = secret_scan.mandatory_strings(r"(foo|ba?r)_x[0-9]+end")
    assert strings == [{"foo_x", "bar_x", "br_x"}, {"end"}]
    for rule in secret_scan.RULES:
        for text in (t for _, t in ROWS):
            if re.search(rule.regex, text):
                low = text.lower()
                assert all(any(s in low for s in clause) for clause in secret_scan.mandatory_strings(rule.pattern))
