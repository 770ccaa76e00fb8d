from __future__ import annotations

import hashlib
import random
import re

from docsync.llm import secret_scan
from docsync.llm.secret_scan import Ledger, Rule
from tests.llm.helpers import ODD, docs

ASSIGN = re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS, HEX = re.compile("AKIA[A-Z0-9]+"), re.compile("[0-9a-f]+")


def spans(text):
    found = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 12]
    found += [(m.start(), 1, "access", m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 18]
    found += [(m.start(), 2, "hex", m.end()) for m in HEX.finditer(text) if len(m[0]) >= 16]
    return ",".join(f"{k}:{s}:{e}" for s, _, k, e in sorted(found))


def read(found):
    return sorted(((r.doc_id is not None, r.doc_id or 0), r.spans, r.base_sha256, r.n_assign, r.n_access, r.n_hex) for r in secret_scan.digest(found).collect())


def want(rows):
    out = []
    for i, t in rows:
        said = spans(t or "")
        count = [said.count(f"{k}:") for k in ("assign", "access", "hex")]
        out.append(((i is not None, i or 0), said, hashlib.sha256(said.encode()).hexdigest(), *count))
    return sorted(out)


def planted(n=150):
    rng = random.Random(11)
    bits = ["token=", "token = password: ", "API_KEY:'", "apikey=\"", "SECRET == ", "passwd:", "AKIA", "AKIAAKIA", "deadbeefdeadbeef", "0123456789abcdef0", "é😀", " ", "\n", "tok\u212aen=", "key", "ABCDEFGHIJKLMN", "abcdefghijkl", "===", "x", "secret=secret=abcdefghijklmnop", "pa\u017f\u017fword=aaaaaaaaaaaaaaaa"]
    return [(i, "".join(rng.choice(bits) for _ in range(rng.randint(0, 25)))) for i in range(n)]


def test_against_plain_search(spark):
    rows = planted() + ODD
    assert read(secret_scan.scan(docs(spark, rows, extra=True), Ledger(spark))) == want(rows)


def test_only_unseen_blobs_are_scanned(spark):
    ledger = Ledger(spark)
    first, second = planted(60), planted(90) + [(1000, "token=" + "a" * 20)] * 3
    version = secret_scan.rules_version(secret_scan.RULES)
    secret_scan.scan(docs(spark, first), ledger)
    before = ledger.read(version).count()
    assert before == len({t for _, t in first})
    assert read(secret_scan.scan(docs(spark, second), ledger)) == want(second)
    assert ledger.read(version).count() == len({t for _, t in first + second})
    secret_scan.scan(docs(spark, second), ledger)
    assert ledger.read(version).count() == len({t for _, t in first + second})
    other = (Rule("hex", "[0-9a-f]{32,}", 32),)
    secret_scan.scan(docs(spark, first), ledger, other)
    assert ledger.read(secret_scan.rules_version(other)).count() == before


def test_entries_added_twice_count_once(spark):
    ledger = Ledger(spark)
    rows = planted(30)
    secret_scan.scan(docs(spark, rows), ledger)
    ledger.append(spark.createDataFrame(ledger.read(secret_scan.rules_version(secret_scan.RULES)).collect(), secret_scan.LEDGER_SCHEMA))
    assert read(secret_scan.scan(docs(spark, rows), ledger)) == want(rows)


def test_empty(spark):
    assert secret_scan.scan(docs(spark, ODD).limit(0), Ledger(spark)).count() == 0


def test_300000_findings_in_one_text(spark):
    text = "".join(f"{'0123456789abcdef'[i % 10:] + 'a' * 16} " for i in range(300_000))
    found = secret_scan.digest(secret_scan.scan(docs(spark, [(1, text)]), Ledger(spark))).first()
    spans = [(m.start(), m.end()) for m in re.finditer("[0-9a-f]{16,}", text)]
    assert found.n_hex == len(spans) == 300_000
    assert found.base_sha256 == hashlib.sha256(",".join(f"hex:{a}:{b}" for a, b in spans).encode()).hexdigest()


def test_no_text_is_shuffled_that_the_ledger_knows(spark, monkeypatch):
    ledger, rows = Ledger(spark), [(i, f"password = {'x' * 20}{i}") for i in range(50)]
    first = secret_scan.scan(docs(spark, rows), ledger).collect()
    looked = []
    monkeypatch.setattr(secret_scan, "find_spans", lambda texts, rules: looked.append(texts.count()) or spark.createDataFrame([], secret_scan.LEDGER_SCHEMA))
    assert sorted(map(str, secret_scan.scan(docs(spark, rows), ledger).collect())) == sorted(map(str, first)) and looked == [0]
