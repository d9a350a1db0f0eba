"""Personal data against the plain patterns."""

import hashlib
import random
import re

from tallyloom.llm.pii import find, luhn, mod97, personal_data
from tallyloom.llm.queries import op9_personal_data

PATTERNS = (
    re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    re.compile(r"[0-9]([\x20-]?[0-9])+"),
    re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
)


def confirmed(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == 1:
        return all(int(p) <= 255 for p in match.split("."))
    if kind == 2:
        return 14 <= len(digits) <= 19 and luhn(digits)
    return kind == 0 or 10 <= len(digits) <= 15


def brute(text):
    found = [
        (m.start(), k, m.end())
        for k, p in enumerate(PATTERNS)
        for m in p.finditer(text or "")
        if confirmed(k, m[0])
    ]
    joined = ",".join(f"{('email', 'ip', 'card', 'phone')[k]}:{a}:{b}" for a, k, b in sorted(found))
    return [sum(f[1] == k for f in found) for k in range(4)], hashlib.sha256(joined.encode()).hexdigest()


def same(row, text):
    counts, digest = brute(text)
    names = ("n_email", "n_ip", "n_card", "n_phone")
    return [row[n] for n in names] == counts and row["base_sha256"] == digest


def test_random_texts_match_the_patterns(documents):
    rng = random.Random(3)
    texts = ["".join(rng.choices("ab1234567890.@+- ()%é\n", k=rng.randrange(400))) for _ in range(400)]
    texts += ["a@b.c@d.ee", "a@b.c%x@d.ee", "@@a@b.c", "1.2.3.4.5.6.7.8", "999.1.1.1.1", "001.02.3.4"]
    texts += ["4111 1111 1111 1111", "+1 (415) 555-0100", None, "", "1" * 100_000, "a" * 100_000 + "@", "1." * 50_000]
    got = {r["doc_id"]: r for r in personal_data(documents(texts)).collect()}
    assert all(same(got[i], t) for i, t in enumerate(texts))


def test_checksums_and_context():
    assert luhn("4111111111111111") and not luhn("4111111111111112")
    assert mod97("GB82WEST12345698765432") and not mod97("GB83WEST12345698765432")
    kinds = lambda text: [s[1] for s in find(text)]
    assert kinds("pay to GB82 WEST 1234 5698 7654 32 now") == [4]
    assert kinds("PAY GB82 WEST 1234 5698 7654 32 AND 7 MORE") == [4]
    assert find("GB82 WEST 1234 5698 7654 32 AND")[0][2] == 27
    assert kinds("0" * 5000 + "1.2.3.4") == [1]
    assert kinds("number 123-45-6789 of parts") == []
    assert kinds("her SSN is 123-45-6789.") == [5]
    assert find("write to a@b.org")[0][3] > find("see a@b.org")[0][3]


def test_empty_table_and_repeated_rows(documents):
    assert personal_data(documents([])).collect() == []
    docs = documents([(1, "a@b.org"), (1, "a@b.org"), (None, "a@b.org")]).selectExpr("*", "1 as spans")
    assert [r["n_email"] for r in personal_data(docs).collect()] == [1, 1, 1]


def test_query_on_the_table(llm):
    sf_dir = "/root/testdata/sf0.01"
    texts = {r[0]: r[1] for r in llm.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    got = op9_personal_data(llm, sf_dir).collect()
    assert len(got) == len(texts)
    assert all(same(r, texts[r["doc_id"]]) for r in got)
