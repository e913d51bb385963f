import hashlib
import random
import re

import pytest

from llm_fixtures import documents, odd  # noqa: F401

from commutewell.llm import secrets

NAMES = ("password", "passwd", "secret", "token", "api_key", "apikey")
VALUE = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"


def run_from(text, at, letters):
    end = at
    while end < len(text) and text[end] in letters:
        end += 1
    return end


def assignment(text, at):
    """End and value's length of an assignment that starts at ``at``, tried letter by letter; None where none does."""
    for name in sorted(NAMES, key=len, reverse=True):
        if "".join(c.lower() if c.isascii() else c for c in text[at : at + len(name)]) != name:
            continue
        pos = at + len(name)
        pos += text[pos : pos + 1] in ('"', "'")
        pos = run_from(text, pos, " ")
        if text[pos : pos + 1] not in (":", "="):
            continue
        pos = run_from(text, pos + 1, " ")
        pos += text[pos : pos + 1] in ('"', "'")
        end = run_from(text, pos, VALUE)
        if end > pos:
            return end, end - pos
    return None


def brute_base(text):
    found, at = [], 0
    while at < len(text):
        hit = assignment(text, at)
        if hit and hit[1] >= 6:
            found.append(("assign", at, hit[0]))
        at = hit[0] if hit else at + 1
    at = 0
    while (at := text.find("AKIA", at)) >= 0:
        end = run_from(text, at + 4, "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")
        if end > at + 4:
            found += [("access", at, end)] if end - at >= 20 else []
            at = end
        else:
            at += 1
    at = 0
    while at < len(text):
        end = run_from(text, at, "0123456789abcdef")
        found += [("hex", at, end)] if end - at >= 24 else []
        at = max(end, at + 1)
    return sorted(found, key=lambda s: (s[1], ("assign", "access", "hex").index(s[0])))


def brute_spans(text):
    """Strong findings and, by trying all pairs, the weak ones that have a complement in their paragraph."""
    strong = brute_base(text)
    weak = secrets.weak_spans(text, strong)
    kept = []
    for kind, start, end in weak:
        for other, low, high in strong + weak:
            if (
                secrets.ROLE[other] in secrets.COMPLEMENT[secrets.ROLE[kind]]
                and low <= end + secrets.REACH and high >= start - secrets.REACH
                and len(re.findall(r"\n[^\S\n]*\n", text[:max(start, low)])) == len(re.findall(r"\n[^\S\n]*\n", text[:min(start, low)]))
            ):
                kept.append((kind, start, end))
                break
    return sorted(strong + kept, key=lambda s: (s[1], secrets.KINDS.index(s[0]), s[2]))


PIECES = [
    "password=", "PassWord : ", 'token" = "', "api_key:", "APIKEY = '", "ſecret=abcdefgh", "secret=token: abcdef123", "passwd==ab",
    "AKIA" + "Q7" * 8, "AKIA" + "Q7" * 7, "AKIAKIA" + "Z" * 20, "0123456789abcdef" * 2, "0123456789abcdef", "user=maria", "login: bob",
    "https://db.example.org/x", "host=db1.local", "wJalrXUtnFEMI7K7MDENGbPxRfiCYzEXAMPLE9aQ", "pwd: hunter22", "auth=xyz", "prose and more",
    "\n", "\n \n", "é 😀", " ", "=", "x" * 150,
]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(9)
    return ["".join(rng.choice(PIECES) + rng.choice(("", " ")) for _ in range(rng.randrange(1, 25))) for _ in range(400)] + ["".join(PIECES) * 40]


def test_equals_brute_force(documents, texts):
    got = {r.doc_id: r for r in secrets.scan(documents([(i, t, None, None, 0) for i, t in enumerate(texts)])).collect()}
    linked = 0
    for i, text in enumerate(texts):
        base, spans = brute_base(text), brute_spans(text)
        row = got[i]
        count = [sum(k == kind for k, _, _ in base) for kind in secrets.BASE]
        assert [row.n_assign, row.n_access, row.n_hex] == count
        assert row.base_sha256 == hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in base).encode()).hexdigest()
        assert row.spans == ",".join(f"{k}:{s}:{e}" for k, s, e in spans)
        linked += row.n_linked
    assert linked > 100


def test_weak_parts_need_each_other(documents):
    random_run = "wJalrXUtnFEMI7K7MDENGbPxRfiCYzEXAMPLE9aQ"
    cases = [
        (f"see {random_run} here", 0),
        ("user=maria wrote", 0),
        ("go to https://example.org/page", 0),
        (f"user=maria {random_run}", 2),
        (f"user=maria{' ' * 199}{random_run}", 2),
        (f"user=maria{' ' * 300}{random_run}", 0),
        (f"user=maria\n\n{random_run}", 0),
        (f"{random_run} at https://db.example.org", 2),
        ("user=maria at https://db.example.org", 0),
        ("user=maria, password=hunter222", 1),
        ("AKIA" + "Q7" * 8 + f" {random_run}", 1),
    ]
    got = {r.doc_id: r.n_linked for r in secrets.scan(documents([(i, t, None, None, 0) for i, (t, _) in enumerate(cases)])).collect()}
    assert got == {i: n for i, (_, n) in enumerate(cases)}


def test_odd_rows(odd, documents):
    rows = secrets.scan(odd).collect()
    assert len(rows) == odd.count()
    assert all(r.spans == "" and r.n_assign == 0 for r in rows)
    assert secrets.scan(documents([])).collect() == []
    twice = secrets.scan(documents([(1, "token=abcdefgh", None, None, 0), (1, "none", None, None, 0), (None, "token=abcdefgh", None, None, 0)]))
    assert sorted((r.n_assign, r.spans) for r in twice.collect()) == [(0, ""), (1, "assign:0:14"), (1, "assign:0:14")]
