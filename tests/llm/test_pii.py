"""Base finds against Python's regular expressions; disclosure by hand-made co-occurrence."""
import random
import re

from starlake.llm import pii


def luhn(s):
    return sum((lambda x: x - 9 if x > 9 else x)(int(c) * (1 + i % 2)) for i, c in enumerate(s[::-1])) % 10 == 0


def digits(s):
    return "".join(c for c in s if c in "0123456789")


PATTERNS = [(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
            (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m[0].split("."))),
            (r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))),
            (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(digits(m[0])) <= 15)]


def slow(text):
    return sorted((m.start(), i, m.end()) for i, (p, ok) in enumerate(PATTERNS) for m in re.finditer(p, text) if ok(m))


def test_base_spans_equal_python():
    rnd = random.Random(6)
    parts = ["a", "b.c", "@", "x@y", ".com", "1", "23", "255", "256", ".", "-", " ", "+", "(", ")", "4111111111111111", "é", "%", "0001", "\n", "12345678901234"]
    for _ in range(6000):
        text = "".join(rnd.choices(parts, k=rnd.randint(1, 25)))
        assert pii.base_spans(text) == slow(text), text
    for text in ("a@b." * 2000, "@" * 5000, "a" * 50_000 + "@b.c", "1" * 3000, "1.2.3." + "0" * 3000 + "4", "+1 " * 3000):
        assert pii.base_spans(text) == slow(text)


def corpus():
    rows = []
    for k in range(6):  # "zephyrcorp" stands near one address only, in different contexts
        rows.append(f"plain words number{k} here\nreport from zephyrcorp team{chr(97 + k) * 3} office mail boss@example.org thanks")
    for k in range(200):
        rows.append(f"mail from user{k}@example.com thanks office report common text {k}")
    rows += ["Zephyrcorp again, without an address"]
    rows += ["uniqueterm mail copy@example.org sent"] * 50  # copies: one context
    return dict(enumerate(rows))


def test_disclosing_terms_are_found_everywhere(docs_of):
    texts = corpus()
    got = {r.doc_id: r.found for r in pii.find(docs_of(texts)).collect()}
    terms = {d: {texts[d][x["start"]:x["end"]].lower() for x in f if x["kind"] in pii.TERM_KINDS} for d, f in got.items()}
    assert all(terms[d] == {"zephyrcorp"} for d in [*range(6), 206])
    assert all(not t for d, t in terms.items() if d not in (*range(6), 206))
    assert {d: [(x["start"], x["at"], x["end"]) for x in f if x["at"] < 4] for d, f in got.items()} == {d: slow(t) for d, t in texts.items()}


def test_alpha_and_support(docs_of):
    none = pii.find(docs_of(corpus()), settings=pii.Settings(support=7)).collect()
    assert not any(x["at"] > 3 for r in none for x in r.found)
    kinds = {x["kind"] for r in pii.find(docs_of({k: v for k, v in corpus().items() if k != 206})).collect() for x in r.found}
    assert "removed" in kinds  # occurs with the address only


def test_sanitised_text(docs_of):
    rows = {**corpus(), 900: None, 901: "", 902: "call +1 (555) 123-4567 or 1.2.3.4"}
    got = {r.doc_id: r.text for r in pii.sanitise(docs_of(rows)).collect()}
    assert got[0] == "plain words number0 here\nreport from [TERM] teamaaa office mail [EMAIL] thanks"
    assert got[206] == "[TERM] again, without an address"
    assert (got[900], got[901], got[902]) == (None, "", "call [PHONE] or [IP]")


def test_edge_cases(docs_of):
    rows = pii.find(docs_of([(1, None), (1, None), (None, "a@b.co"), (2, "")])).collect()
    assert sorted((str(r.doc_id), len(r.found)) for r in rows) == [("1", 0), ("1", 0), ("2", 0), ("None", 1)]
    assert pii.find(docs_of({})).collect() == []
    long = "word " * 200_000 + "me@example.org " + "tail " * 200_000
    assert [(x["start"], x["end"]) for r in pii.find(docs_of({1: long})).collect() for x in r.found] == [(1_000_000, 1_000_014)]


def test_rare_values_are_judged_by_class_and_by_bound(docs_of):
    rows = [f"ask mira{chr(97 + k) * 3} of the quellwerk plant k{k}{chr(97 + k)}@quell.example now" for k in range(4)]  # each address once
    rows += [f"{w} saw ombrelune reach lone@rare.example {w}" for w in ("anna", "bert")]  # one address, two contexts
    rows += [f"nothing of the plant here, ask and reach now, they saw number {k}" for k in range(400)]
    terms = lambda **s: {r.text[x["start"]:x["end"]] for r in
                            pii.find(docs_of(dict(enumerate(rows))), settings=pii.Settings(**s), with_text=True).collect()
                            for x in r.found if x["kind"] in pii.TERM_KINDS}
    assert terms() == {"quellwerk"}
    assert terms(doubt=0.5) >= {"quellwerk", "ombrelune"}
    assert "ombrelune" not in terms(doubt=0.01)


def test_entities():
    assert pii.entities(0, "A.b@C.org") == ("email:a.b@c.org", "email class:c.org")
    assert pii.entities(1, "1.2.3.4") == ("ip:1.2.3.4", "ip class:1.2.3")
    assert pii.entities(2, "4111 1111-11111111") == ("card:4111111111111111", "card class:411111")
    assert pii.entities(3, "+1 (555) 123-4567") == ("phone:15551234567", "phone class:1555123")
