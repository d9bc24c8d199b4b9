"""Surrogates: that drawing ends, that no real value stays, that names are coreferent, that columns pass."""

import re

from millrace.llm import private

TEXT = (
    "Mrs. Anna Smith met Mr. Bob Jones. Anna Smith left; Smith was late. Mrs. Smith came back. Write to Bob Jones. "
    "Smithson and Annabel stay; Herr Lutz-Meier saw Meier and Lutz-Meier."
)


def run(spark, rows, schema="doc_id bigint, text string", **options):
    return {r.doc_id: r for r in private.replaced(spark.createDataFrame(rows, schema), "k", **options).collect()}


def test_names_are_replaced_wherever_they_stand(spark):
    rows = [(1, TEXT), (2, "Frau Smith and Smith"), (3, "Smith alone is no name here"), (4, TEXT)]
    out = run(spark, rows)
    one = out[1].text
    assert not re.search(r"\b(Anna|Smith|Bob|Jones|Lutz)\b", one) and "Smithson and Annabel stay" in one
    first, last = re.match(r"Mrs\. (\S+) (\S+) met Mr\. (\S+) (\S+)\.", one).groups()[:2]
    assert f"{first} {last} left; {last} was late. Mrs. {last} came back." in one
    assert out[2].text == f"Frau {last} and {last}" and out[3].text == rows[2][1] and out[4].text == one
    assert out[1].n_entities == 4 and out[3].n_entities == 0


def test_drawing_ends_for_small_and_empty_spaces(spark):
    secrets = ["******", "секрет", "-_-_-_-", *(f"{c}-----" for c in "abcdefghijklmnopqrstuvwxyz")]
    ibans = [f"AB{n:02} ABCD EFGH IJKL" for n in range(100)] + [f"CD{n:02} ABCD EFGH" for n in range(100)]
    phones = [f"+1 {n:02} {m:02}" for n in range(20) for m in range(20)]
    ips = [f"192.168.{a}.{b}" for a in range(20) for b in range(20)]
    values = [f'password = "{s}"' for s in secrets] + ibans + phones + ips
    out = run(spark, [(i, f"{i}: {v};") for i, v in enumerate(values)])
    bare = [re.sub(r"^\d+: |;$", "", out[i].text) for i in range(len(values))]
    assert all(out[i].n_entities == 1 for i in range(len(values)))
    assert len(set(bare)) == len(values) and not set(bare) & set(values)
    assert all(re.fullmatch(r'password = "\S{6,8}"', b) for b in bare[: len(secrets)])
    assert all(re.fullmatch(r"[A-Z]{2}\d\d( [A-Z]{4}){2,3}", b) for b in bare[len(secrets) :][:200])
    assert all(re.fullmatch(r"(192\.168|10\.\d+)\.\d+\.\d+", b) for b in bare[-400:])


def test_check_digits_issuers_and_ranges_are_kept(spark):
    iban, card = "DE89 3704 0044 0532 0130 00", "4111 1111 1111 1111"
    out = run(spark, [(1, f"{iban} and {iban.replace(' ', '')}, card {card}, 10.1.2.3 or 172.20.0.1 or 8.8.8.8")])[1].text
    spaced, joined, digits, *ips = re.fullmatch(r"(DE[\d ]{25}) and (DE\d{20}), card ([\d ]{19}), (\S+) or (\S+) or (\S+)", out).groups()
    assert spaced.replace(" ", "") == joined != iban.replace(" ", "")
    assert int("".join(str(int(c, 36)) for c in joined[4:] + joined[:4])) % 97 == 1
    numbers = [int(c) for c in digits if c.isdigit()][::-1]
    assert digits[0] == "4" and sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(numbers)) % 10 == 0
    assert ips[0].startswith("10.") and re.match(r"172\.(1[6-9]|2\d|3[01])\.", ips[1]) and ips[2] != "8.8.8.8"


def test_columns_of_any_name_pass(spark):
    schema = "doc_id bigint, text string, _found string, _key int, _row string, _new int, _pieces string, i int, kind string"
    rows = [(1, "mail a.b@c.example now \x01\x02", "f", 1, "r", 2, "p", 3, "k"), (2, None, None, None, None, None, None, None, None), (None, "", "f", 1, "r", 2, "p", 3, "k")]
    out = run(spark, rows, schema)
    assert all(tuple(out[r[0]])[2:-1] == r[2:] for r in rows) and out[2].text is None and out[None].text == ""
    assert re.fullmatch(r"mail [a-z]\.[a-z]@[a-z]\.example now \x01\x02", out[1].text)
    assert private.replaced(spark.createDataFrame(rows, schema).limit(0), "k").count() == 0
    alone = private.private_filter(spark.createDataFrame([("mail a.b@c.example",), (None,)], "text string"), "k")
    assert alone.columns == ["text"] and alone.count() == 2
