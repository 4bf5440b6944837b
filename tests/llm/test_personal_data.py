"""Base spans against plain regular expressions, and what checksums and context add."""

import random
import re
import time

import pytest

from textweft.llm.personal_data import BASE, DIGEST, find_personal_data, find_spans, joined, luhn, mod97, redacted

SLOW = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def slow(text):
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    keep = {
        "email": lambda m: True,
        "ip": lambda m: all(int(p) <= 255 for p in m[0].split(".")),
        "card": lambda m: 13 <= len(digits(m)) <= 19 and luhn(digits(m)),
        "phone": lambda m: 9 <= len(digits(m)) <= 15,
    }
    return {k: [m.span() for m in re.finditer(p, text) if keep[k](m)] for k, p in SLOW.items()}


def test_base_spans():
    rng = random.Random(2)
    parts = ["a", "b.", "@", "1", "12", "255", "256", "0001", ".", "-", " ", "+", "(", ")", "é", "a@b.c", "1.2.3.4", "_", "٣"]
    parts += ["4111111111111111", "+1 (555) 123-4567"]
    for _ in range(20_000):
        text = "".join(rng.choices(parts, k=rng.randint(0, 25)))
        found = find_spans(text)
        assert {k: found[k] for k in BASE} == slow(text), text


def test_added_kinds():
    iban = "GB82 WEST 1234 5698 7654 32"
    assert mod97(iban.replace(" ", "")) and not mod97("GB82WEST12345698765433")
    found = find_spans(f"pay to {iban}, my social security number 123-45-6789, token = \"{'ab12' * 10}\"")
    assert len(found["iban"]) == len(found["ssn"]) == len(found["secret"]) == 1
    assert not find_spans("part 123-45-6789 of the list")["ssn"]  # no context word nearby
    assert not find_spans("GB82 WEST 1234 5698 7654 33")["iban"]  # wrong checksum


@pytest.mark.parametrize("iban", ["DE89 3704 0044 0532 0130 00", "DE89370400440532013000", "GB82 WEST 1234 5698 7654 32", "NO93 8601 1117 947"])
@pytest.mark.parametrize("before", ["", "IBAN ", "REF AB12 ", "AB12 CD34 "])
@pytest.mark.parametrize("after", ["", ".", " BIC COBADEFF", " 2024", " EUR 50", " A 1 B 2 C 3 D 4 E 5", " Bank", " GB82 WEST 1234 5698 7654 32"])
def test_account_numbers_among_upper_case_words(iban, before, after):
    text = before + iban + after
    found = find_spans(text)["iban"]
    assert (len(before), len(before) + len(iban)) in found and len(found) == 1 + after.count("GB82")
    assert iban not in redacted(text, find_spans(text))


def test_many_account_heads_take_linear_time():
    began = time.process_time()
    find_spans("AA11 " * 60_000)
    find_spans("AA11" + "A1" * 150_000)
    assert time.process_time() - began < 10


def test_redaction():
    text = "Mail é@x a.b@c.de or +1 (555) 123-4567"
    assert redacted(text, find_spans(text)) == "Mail é@x <EMAIL> or <PHONE>"


@pytest.mark.parametrize("text", ["1" * 300_000, "a" * 300_000 + "@", "+1" + "(" * 300_000, "AA11" * 90_000, "1.1." * 90_000, "A1 " * 90_000])
def test_time_is_linear(text):
    began = time.process_time()
    find_spans(text)
    assert time.process_time() - began < 5


def test_table(hard_docs):
    rows = find_personal_data(hard_docs).collect()
    assert len(rows) == hard_docs.count()
    for r in rows:
        found = find_spans(r.text or "")
        assert r.spans == joined(found, tuple(found)) and r.redacted == r.text and r.n_words == "own"
    empty = hard_docs.limit(0)
    assert find_personal_data(empty, DIGEST).collect() == []
