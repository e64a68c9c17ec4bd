"""Personal data against plain Python, with the plain patterns."""

import hashlib
import random
import re

from tests.llm.cases import SF, SCHEMA, edge_documents, edge_rows, given, no_documents
from tidemark.llm import personal_data as pd
from tidemark.llm.queries import QUERIES

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(found: str) -> bool:
    digits = [int(c) for c in found if c.isdigit()][::-1]
    return sum(sum(divmod(d * (1 + i % 2), 10)) for i, d in enumerate(digits)) % 10 == 0


def good(kind: str, found: str) -> bool:
    n = sum(c.isdigit() for c in found)
    return {
        "email": lambda: True,
        "ip": lambda: all(int(x) <= 255 for x in found.split(".")),
        "card": lambda: 16 <= n <= 19 and luhn(found),
        "phone": lambda: 8 <= n <= 15,
    }[kind]()


def base(text: str | None) -> list[tuple[str, int, int]]:
    text = text or ""
    return [(k, m.start(), m.end()) for k, p in PLAIN.items() for m in re.finditer(p, text) if good(k, m.group())]


def spans(df) -> list:
    return [(r.doc_id, [(s.kind, s.start, s.stop) for s in r.spans]) for r in df.select("doc_id", "spans").collect()]


def only_base(found):
    return [s for s in found if s[0] in PLAIN]


def frame(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")


def test_edge_cases(spark):
    got = spans(pd.find_personal_data(edge_documents(spark)))
    assert sorted((str(i), only_base(s)) for i, s in got) == sorted((str(r[0]), base(r[1])) for r in edge_rows())
    assert pd.find_personal_data(no_documents(spark)).count() == 0


def test_random_texts(spark):
    rnd = random.Random(7)
    texts = []
    for alphabet in ("a@.-_ b9", "0123456789 -.", "+1 (0)-.5 ", "é@a.b1+ 2.", "25.5.5.6 .", "aZ@.c%"):
        texts += ["".join(rnd.choice(alphabet) for _ in range(rnd.choice([6, 20, 60, 200]))) for _ in range(120)]
    texts += ["+" + "1 " * 9, "1" * 40, "a@b.c_d@e.f", "x@y@z.com", "0000255.1.1.1 256.1.1.1 1.2.3.4.5.6.7.8", "4111 1111 1111 1111 4111111111111112"]
    texts += ["€" * 10 + "a@b.co" + "\U0001f600" * 5 + " 4111-1111-1111-1111"]
    got = dict(spans(pd.find_personal_data(frame(spark, texts))))
    for i, t in enumerate(texts):
        assert only_base(got[i]) == base(t), t


def test_linear_on_long_runs(spark):
    """Texts on which the plain patterns take quadratic time."""
    texts = ["a" * 300_000 + "@", "1" * 300_000 + "@ 1.1", "+1" + "(" * 300_000, "a@b" + ".c" * 100_000, "1 " * 200_000]
    got = dict(spans(pd.find_personal_data(frame(spark, texts))))
    assert got[3] == [("email", 0, 200_003)] and not got[0] and not got[1] and not got[2]


def test_checksums_and_context(spark):
    iban, short = "DE89 3704 0044 0532 0130 00", "378282246310005"
    texts = [f"iban {iban}.", f"iban {iban[:-1]}1.", f"my card: {short}", f"number {short}", "GB82WEST12345698765432", f"{short} visa"]
    got = dict(spans(pd.find_personal_data(frame(spark, texts))))
    kinds = {i: [s[0] for s in v if s[0] not in PLAIN] for i, v in got.items()}
    assert kinds == {0: ["iban"], 1: [], 2: ["account"], 3: [], 4: ["iban"], 5: ["account"]}
    assert got[0][-1] == ("iban", 5, 5 + len(iban))


def test_redact(spark):
    texts = ["mail a@b.co, a@b.co now", None, "none", "é 4111 1111 1111 1111", "+4111111111111111 x"]
    out = pd.redact(pd.find_personal_data(frame(spark, texts)))
    assert [r.text for r in out.orderBy("doc_id").collect()][:4] == ["mail <email>, <email> now", None, "none", "é <card>"]


def test_query(spark):
    rows = {r.doc_id: r for r in QUERIES["op6_personal_data"](spark, SF).collect()}
    docs = given()
    assert len(rows) == len(docs)
    for d in docs:
        want, r = base(d["text"]), rows[d["doc_id"]]
        assert [r[f"n_{k}"] for k in PLAIN] == [sum(s[0] == k for s in want) for k in PLAIN]
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert r.spans.startswith(text)
    assert any(r.n_email for r in rows.values()) and any(r.n_card for r in rows.values())


def test_plan_is_native(spark):
    plan = pd.find_personal_data(spark.createDataFrame([], SCHEMA))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
