import hashlib
import random
import re
import time

import pytest
from cases import documents

from millrace.llm import pii

ROWS = [
    (1, "Write to ann.b+c@mail.example.com, or a@b or @x.y."), (2, "hosts 10.0.0.1, 300.1.1.1 and 1.2.3.4.5"),
    (3, "card 4111 1111 1111 1111 and 4111-1111-1111-1112, call +1 (743) 555-3824 or +12 34"), (4, None), (5, ""),
    (6, 'token = "2321bac4d15ec8f90433955bf9d3cf61da5bdd1e" é 😀 ip 8.8.8.8'), (7, "Dear Mary Smith, hello"),
    (8, "x" * 50_000 + " a@b.co " + "9 " * 3000), (9, "id 123456789012"), (9, "id 123456789012"), (None, "me@here.org"),
    (10, "007.08.9.010 +1234567890123456 4111111111111111 4111111111111111"),
]


def plain(text):
    text, out = text or "", []
    kinds = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
        ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
    ]
    for order, (kind, pattern) in enumerate(kinds):
        for m in re.finditer(pattern, text):
            digits = [int(c) for c in m.group() if c in "0123456789"]
            if kind == "ip" and max(int(p) for p in m.group().split(".")) > 255:
                continue
            if kind == "card":
                twice = [d if k % 2 == 0 else sum(divmod(2 * d, 10)) for k, d in enumerate(digits[::-1])]
                if not 14 <= len(digits) <= 19 or sum(twice) % 10:
                    continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            out.append((m.start(), order, f"{kind}:{m.start()}:{m.end()}"))
    return ",".join(x[2] for x in sorted(out))


def test_base_spans_equal_brute_force(spark):
    got = pii.find(documents(spark, ROWS)).collect()
    assert len(got) == len(ROWS)
    said = sorted((str(r.doc_id), ",".join(f"{s.kind}:{s.start}:{s.end}" for s in r.spans if s.base)) for r in got)
    assert said == sorted((str(i), plain(t)) for i, t in ROWS)


def test_more_spans_leave_base_spans_alone(spark):
    for r in pii.find(documents(spark, ROWS)).collect():
        base = [(s.start, s.end) for s in r.spans if s.base]
        for s in r.spans:
            assert s.base or not any(a < s.end and s.start < b for a, b in base)
        assert [s.start for s in r.spans] == sorted(s.start for s in r.spans)


def test_reliability_comes_from_agreement():
    """Cue and context agree on secrets; short numbers without either are not personal."""
    counts = {("secret", "yyy-y5"): 200, ("secret", "y-y-y5"): 20, ("number", "nn--n1"): 300, ("number", "nn-ny1"): 80,
              ("number", "yy--y3"): 40, ("email", "y---y4"): 500}
    p = pii.fit(counts)
    assert p["secret", "yyy-y5"] > 0.9 and p["email", "y---y4"] > 0.9 and p["number", "yy--y3"] > 0.5
    assert p["number", "nn--n1"] < 0.2 and p["number", "nn-ny1"] < 0.2
    assert pii.fit({}) == {}


def test_redaction(spark):
    rows = {r.doc_id: r.text for r in pii.redact(documents(spark, ROWS)).collect() if r.doc_id}
    assert rows[1] == "Write to [email], or a@b or @x.y." and rows[4] is None and rows[5] == ""
    assert "4111 1111 1111 1111" not in rows[3] and "[phone]" in rows[3]


def test_empty_table(spark):
    assert pii.find(documents(spark, [])).count() == 0


def test_empty_digest():
    assert hashlib.sha256(plain(None).encode()).hexdigest() == hashlib.sha256(b"").hexdigest()


def test_names_behind_punctuation(spark):
    said = ['"John Miller"', "(Peter Huber)", "Mr.James Smith", "name:Mary Jones", "“Hans Weber”", "©José García", "x_John Miller"]
    found = pii.count_votes(documents(spark, list(enumerate(said))))
    assert sum(n for (kind, _), n in found.items() if kind == "name") == len(said) - 1


ALPHABETS = ["a@.", "a@.-1", "01.", "1 -", "+1 ()", "_a1 ", "a.b@c d", "25.0"]


@pytest.mark.parametrize("alphabet", ALPHABETS)
def test_fast_matches_equal_the_patterns(alphabet):
    rng = random.Random(alphabet)
    old_secret = re.compile(pii._SECRET.pattern.replace("(?<![0-9A-Za-z_])", "(?<![0-9A-Za-z])"))
    for _ in range(3000):
        text = "".join(rng.choices(alphabet, k=rng.randrange(40)))
        for kind, pattern in pii.PATTERNS.items():
            assert list(pii._matches(kind, text)) == [m.span() for m in pattern.finditer(text)]
        long = text.replace("a", "abcdefg")
        assert [m.span() for m in pii._SECRET.finditer(long)] == [m.span() for m in old_secret.finditer(long)]


@pytest.mark.parametrize("run", ["1", "0", "_", "a", "a.", "1.", "@", "@a", "a@", "+1 ", "-", "é", "1 ", "(", "James "])
def test_a_run_of_a_million_characters(run):
    text = f"me@here.org {run * (1_000_000 // len(run))} 8.8.8.8 {'0' * 5000}.0.0.0 {'1' * 5000}.1.1.1"
    started = time.process_time()
    base = pii.base_spans(text)
    more = pii.more_spans(text, base, True)
    for span in (base + more)[:100]:
        pii.votes(text, *span)
    assert time.process_time() - started < 20
    kinds = [(text[a:b], k) for a, b, k in base]
    assert ("8.8.8.8", "ip") in kinds and ("0" * 5000 + ".0.0.0", "ip") in kinds
    assert any(k == "email" for _, k in kinds) and not any("1" * 5000 in t for t, k in kinds if k == "ip")
