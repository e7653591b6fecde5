import datetime
import re
import time

import pytest
from pyspark.sql import functions as F

from ledgerline.llm import pii, queries

KEY = b"test"


@pytest.mark.parametrize("size", [1, 2, 3, 10, 97, 1000])
def test_permute_is_a_permutation_with_an_inverse(size):
    out = [pii.permute(x, size, KEY, "k") for x in range(size)]
    assert sorted(out) == list(range(size))
    assert [pii.permute(y, size, KEY, "k", True) for y in out] == list(range(size))


def valid_card(text):
    digits = [int(c) for c in text if c.isdigit()]
    total = sum(digits[-1::-2]) + sum(d * 2 - 9 * (d > 4) for d in digits[-2::-2])
    return total % 10 == 0


SAMPLES = {
    "card": ["4111111111111111", "4111 1111 1111 1111", "5500-0055-5555-5559", "378282246310005"],
    "account": ["DE89370400440532013000", "GB82 WEST 1234 5698 7654 32"],
    "social": ["123-45-6789", "665-01-0001", "899-99-9999"],
    "phone": ["+1 (743) 555-3824", "+49 30 123456", "(415) 555-1212", "415-555-1212"],
    "address": ["192.168.0.1", "8.8.8.8"],
    "date": ["1999-12-31", "31.12.1999", "12/31/1999", "2024-02-29", "1/2/2003"],
    "mail": ["hein.19@mail5.example.com", "A_b+c@x.org"],
    "secret": ["24be64439e3e49cf46b2d7c90f3602a3d0b907ff"],
}


@pytest.mark.parametrize("kind", sorted(SAMPLES))
def test_formats_are_kept_and_undone(kind):
    for value in SAMPLES[kind]:
        text = f"before {value}, after"
        new, found = pii.pseudonymised(text, KEY)
        assert [(k, text[s:e]) for k, s, e in found] == [(kind, value)]
        shown = new.removeprefix("before ").removesuffix(", after")
        assert shown != value
        if kind not in ("address", "secret", "mail", "date"):
            assert re.sub(r"\d", "0", shown) == re.sub(r"\d", "0", value)
        if kind == "card":
            assert valid_card(shown)
        if kind == "date" and "-" in shown:
            datetime.date.fromisoformat(shown)
        assert pii.pseudonymised(new, KEY, True)[0] == text or kind == "date"
        assert pii.pseudonymised(text, b"other")[0] != new


@pytest.mark.parametrize(
    ("kind", "value", "behind"),
    [
        ("card", "4111 1111 1111 1111", " 12/25"),
        ("card", "4111 1111 1111 1111", " 123"),
        ("card", "4111111111111111", " 123"),
        ("card", "4111-1111-1111-1111", " 12-25"),
        ("card", "3782 822463 10005", " 1234"),
        ("card", "41111111 11111111", " 12/25"),
        ("account", "BE68 5390 0754 7034", " AND"),
        ("account", "BE68 5390 0754 7034", " 2024"),
        ("account", "BE68539007547034", " BIC"),
        ("account", "BE68539007547034", " KREDBEBB"),
        ("account", "DE89 3704 0044 0532 0130 00", " COBADEFFXXX"),
        ("account", "NO93 8601 1117 947", " AND"),
        ("phone", "+1 743 555 3824", " 2026 77"),
    ],
)
def test_a_value_is_found_before_words_and_numbers(kind, value, behind):
    text = f"x {value}{behind} y"
    new, found = pii.pseudonymised(text, KEY)
    assert found[0][0] == kind and text[found[0][1] :].startswith(value[:4]) and value not in new
    if kind != "phone":
        assert [(k, text[s:e]) for k, s, e in found] == [(kind, value)]
        assert new == pii.pseudonymised(f"x {value}", KEY)[0] + behind + " y"
        assert pii.pseudonymised(new, KEY, True)[0] == text


def test_a_value_is_found_behind_a_number_and_behind_another():
    accounts = "BE68 5390 0754 7034", "BE71 0961 2345 6769"
    new, found = pii.pseudonymised(" ".join(accounts), KEY)
    assert len(found) == 2 and new == " ".join(pii.pseudonymised(a, KEY)[0] for a in accounts)
    text = "order 17 4111 1111 1111 1111"
    new, found = pii.pseudonymised(text, KEY)
    assert [text[s:e] for _, s, e in found] == ["4111 1111 1111 1111"]


def test_equal_values_stay_linked():
    one, two, three = (
        pii.pseudonymised(t, KEY)[0] for t in ("pay 4111111111111111", "4111 1111 1111 1111 again", "a 4012888888881881")
    )
    digits = [re.sub(r"\D", "", t) for t in (one, two, three)]
    assert digits[0] == digits[1] != digits[2]


@pytest.mark.parametrize(
    "values",
    [
        ["+17435553824", "+1 743 555 3824", "+1 (743) 555-3824", "+1743 555 3824"],
        ["+4930123456", "+49 30 123456", "+49 (30) 12 34 56"],
        ["+35312345678", "+353 12 345 678"],
        ["+3531234", "+353 12 34"],
        ["john.smith7@x.com", "John.Smith7@x.com", "JOHN.SMITH7@x.com"],
    ],
)
def test_equal_values_in_other_styles_stay_linked(values):
    new = [pii.pseudonymised(f"by {v}", KEY)[0].removeprefix("by ") for v in values]
    assert len({re.sub(r"[ ()\-]", "", v).lower() for v in new}) == 1
    for value, shown in zip(values, new, strict=True):
        assert shown[:2] == value[:2] if value[0] == "+" else [c.isupper() for c in shown] == [c.isupper() for c in value]
        assert shown != value and pii.pseudonymised(f"by {shown}", KEY, True)[0] == f"by {value}"


def test_what_is_not_valid_stays():
    text = "4111111111111112 and 999.1.1.1 and 2023-02-30 and 000-12-3456 and version 2.0 and 12345 and DE00370400440532013000"
    assert pii.pseudonymised(text, KEY) == (text, [])


def test_query(spark):
    given = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    rows = queries.QUERIES["op8_pseudonyms"](spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == len(given) and sum(r.n_found for r in rows) > 60
    for r in rows:
        text, spans = pii.pseudonymised(given[r.doc_id], queries.PII_KEY)
        assert r.text == text and [(f.kind, f.start, f.end) for f in r.found] == spans and r.n_found == len(spans)
        assert len(r.text) >= len(given[r.doc_id]) - 12 * r.n_found
        for f in r.found:
            assert f.kind == "mail" or given[r.doc_id][f.start : f.end] not in r.text


def test_edges(spark):
    rows = [(1, None), (2, ""), (None, "call +1 (743) 555-3824"), (3, "x " * 50_000 + "8.8.8.8"), (3, "8.8.8.8"), (3, "8.8.8.8")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("new", F.lit(1)).withColumn("found", F.lit(2))
    out = sorted((str(r.doc_id), r.text is None, r.n_found) for r in pii.pseudonyms(df, KEY).collect())
    assert out == [("1", True, 0), ("2", False, 0), ("3", False, 1), ("3", False, 1), ("3", False, 1), ("None", False, 1)]
    assert pii.pseudonyms(df.limit(0), KEY).count() == 0


def test_phone_styles_of_one_number_are_linked():
    shown = ["(743) 555-3824", "743-555-3824", "+1 743 555 3824", "+17435553824"]
    new = [pii.pseudonymised(f"at {v}", KEY)[0].removeprefix("at ") for v in shown]
    digits = {"".join(c for c in v if c.isdigit())[-10:] for v in new}
    assert len(digits) == 1 and digits != {"7435553824"}
    assert [pii.pseudonymised(f"at {v}", KEY, True)[0] for v in new] == [f"at {v}" for v in shown]


def test_letters_beside_an_at_sign_take_linear_time():
    start = time.perf_counter()
    text = "a" * 1_000_000 + " @ " + "b" * 1_000_000 + "@x.org _john@x.org a@b.com@c.org"
    new, found = pii.pseudonymised(text, KEY)
    assert time.perf_counter() - start < 30
    assert [text[s:e] for _, s, e in found][1:] == ["john@x.org", "a@b.com"]
    assert found[0][2] - found[0][1] == 1_000_006
    assert pii.pseudonymised(new, KEY, True)[0] == text
