import random
import re

import pytest
from pyspark.sql import functions as F

from placeleads import constants as c
from placeleads.functions import contact


def plain_phone(text):
    for pattern in c.PHONE_PATTERNS:
        found = re.search(pattern, text, flags=re.ASCII)
        if found and len(re.findall("[0-9]", found.group())) >= c.MIN_PHONE_DIGITS:
            return found.group()
    return None


def plain_emails(text):
    pattern = c.EMAIL
    return re.findall(pattern, text)


@pytest.mark.parametrize(
    "text, phone",
    [
        ("+34 912 345 678", "+34 912 345 678"),
        ("+34 91 234 56 78", "+34 91 234 56"),  # cut short by the pattern
        ("(555) 123-4567", "555) 123-4567"),  # the first pattern has no opening bracket
        ("call 912 345 678 now", "912 345 678"),
        ("Calle 1014 call 912 345 6789", "912 345 6789"),  # third pattern
        ("Calle 1014, call 912345678", None),  # first match too short
        ("1.2.3.4567", "1.2.3.4567"),  # looks like an address of a computer
        ("no digits", None),
        ("", None),
        (None, None),
    ],
)
def test_phone(one, text, phone):
    assert one(contact.extract_phone, text) == phone


def test_phone_equals_plain_patterns(many):
    rng = random.Random(1)
    texts = ["".join(rng.choices("0123456789+()-. x", k=rng.randint(0, 40))) for _ in range(3000)]
    assert many(contact.extract_phone, texts) == [plain_phone(t) for t in texts]


def test_email_matches_equal_plain_pattern(many):
    rng = random.Random(2)
    alphabet = "ab.@@-_% \n1"
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 60))) for _ in range(3000)]
    texts += ["a@b.com_x@y.com", "a@b.comx@y.com", "..@b.co", "x" * 50 + "@y.org", "a@b.c d@e.fg"]
    assert many(contact.email_matches, texts) == [plain_emails(t) for t in texts]


def test_long_run_without_at_sign_is_quick(one):
    text = "a" * 2_000_000 + " x@y.es"
    assert one(contact.email_matches, text) == ["x@y.es"]


def test_emails_block_list_is_a_substring_test(one):
    text = "A@B.es a@b.es A@B.es x@Google.com.mx y@sub.example.com"
    assert one(contact.extract_emails, text) == ["A@B.es", "a@b.es"]
    kept = one(lambda t: contact.extract_emails(t, blocked=()), text)
    assert kept == ["A@B.es", "a@b.es", "x@Google.com.mx", "y@sub.example.com"]
    assert one(contact.extract_emails, None) == []


def test_glued_text_extends_a_match(one):
    assert one(contact.extract_emails, "a@b.comWebsite") == ["a@b.comWebsite"]


def test_lookup_candidates_keep_duplicates(one):
    text = "a@yahoo.com b@c.es b@c.es d@e.es"
    assert one(contact.lookup_candidates, text) == ["b@c.es", "b@c.es", "d@e.es"]


@pytest.mark.parametrize(
    "text, email",
    [
        ("x@shop.es y@GMAIL.com z@gmail.com", "y@GMAIL.com"),
        ("x@shop.es z@other.es", "x@shop.es"),
        ("x@facebook.com", None),
        ("nothing", None),
    ],
)
def test_preferred_email(one, text, email):
    found = one(lambda t: contact.preferred_email(contact.lookup_candidates(t)), text)
    assert found == email


@pytest.mark.parametrize(
    "address, city",
    [
        ("Calle 1, Madrid, Spain", "Madrid"),
        ("Calle 1, Madrid , Spain", "Madrid"),
        ("Calle 1, Spain", "Calle 1"),
        ("Calle 1", ""),
        (None, ""),
    ],
)
def test_city(one, address, city):
    assert one(contact.address_city, address) == city


def test_lookup_query(spark):
    rows = [("Bar", "Calle 1, Madrid, Spain"), ("Bar", None), (None, "a, b, c")]
    df = spark.createDataFrame(rows, "n string, a string")
    found = df.select(contact.lookup_query(F.col("n"), F.col("a")).alias("q")).collect()
    assert [r["q"] for r in found] == ["Bar Madrid email", "Bar  email", None]
