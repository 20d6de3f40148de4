"""Secret scans against a plain version, and their time on texts without white space."""

from __future__ import annotations

import time

import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

from loomframe.llm import secrets
from loomframe.llm.queries import QUERIES, table

SF = "/root/testdata/sf0.01"
CANDIDATE = regex.compile(secrets.CANDIDATE.replace(r"\z", r"\Z"), regex.VERSION0)


@pytest.fixture(scope="module")
def forest(spark):
    return secrets.fit(secrets.labelled_findings(spark))


def runs(kinds: str, of: str) -> int:
    return max((len(m) for m in regex.findall(f"[{of}]+", kinds)), default=0)


def plain_features(text: str, before: str, after: str) -> dict:
    """Every feature, in plain Python."""
    n, low, lead = len(text), text.lower(), before.lower()
    kinds = "".join("a" if "a" <= c <= "z" else "A" if "A" <= c <= "Z" else "0" if "0" <= c <= "9" else "-" for c in text)
    letters = sum(c in "aA" for c in kinds)
    key = r"(token|secret|passw|pwd|{}credential|bearer|auth)"
    return {
        "length": n,
        "digits": kinds.count("0") / n,
        "uppers": kinds.count("A") / n,
        "symbols": kinds.count("-") / n,
        "transitions": sum(a != b for a, b in zip(" " + kinds, kinds, strict=False)) / n,
        "letters_run": runs(kinds, "aA") / n,
        "distinct": len(set(text)) / min(n, 64),
        "repeated": max((len(m[0]) for m in regex.finditer(r"(.)\1+", text)), default=1),
        "hexadecimal": bool(regex.fullmatch("[0-9a-f]+|[0-9A-F]+", text)),
        "grouped": bool(regex.fullmatch("[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}", text)),
        "vowels": sum(c in "aeiou" for c in low) / max(1, letters),
        "words": 1 - len(regex.sub("|".join(secrets.WORDS), "", low)) / n,
        "slashes": text.count("/"),
        "in_path": bool(regex.search(r"(://[^ ]*|[/.@#])$", before) or regex.match(r"[.][a-z]{2,4}([^a-z]|$)", after)),
        "head": bool(regex.match(r"AKIA|ASIA|gh[pousr]_|xox[abp]-|sk[-_]|eyJ|AIza|-----BEGIN", text)),
        "key_word": bool(regex.search(r"(token|secret|passw|pwd|api.?key|access.?key|private|credential|bearer|auth)[^a-z]*$", lead)),
        "key_near": bool(regex.search(key.format("key|"), lead)),
        "assigned": bool(regex.search(r"[=:] ?[\"']?$", before)),
        "quoted": bool(regex.search(r"[\"']$", before) and regex.match(r"[\"']", after)),
        "userinfo": bool(regex.search("//[^ /]*:$", before) and after.startswith("@")),
        "before_at": before.endswith(":") and after.startswith("@"),
        "spaces": text.count(" "),
    }


def plain_candidates(text: str) -> list[tuple[str, str, str]]:
    """Candidates with what stands before and after, at most up to the end of their neighbours."""
    found = list(CANDIDATE.finditer(text))
    out = []
    for i, m in enumerate(found):
        first = found[i - 1].start() if i else 0
        last = found[i + 1].end() if i + 1 < len(found) else len(text)
        out.append((m[0], text[max(first, m.start() - secrets.BEFORE) : m.start()], text[m.end() : min(last, m.end() + secrets.AFTER)]))
    return out


def test_query_equals_a_plain_scan(spark, forest):
    """Candidates, what stands around them, most features and the votes of the trees, document by document."""
    docs = table(spark, SF, "documents").select("doc_id", "text")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    found = secrets.with_candidates(docs).selectExpr("doc_id", "posexplode(_listed) AS (place, c)")
    rows = secrets.describe(found.select("doc_id", "place", "c.*")).collect()
    made = {(r.doc_id, r.place): r for r in rows}
    expected = {(i, n): c for i, t in texts.items() for n, c in enumerate(plain_candidates(t))}
    assert {k: (r.text, r.before, r.after) for k, r in made.items()} == expected and len(expected) > 20
    for key, (text, before, after) in expected.items():
        for name, value in plain_features(text, before, after).items():
            assert made[key][name] == pytest.approx(float(value)), (name, text)
    table_ = np.array([[made[k][n] for n in secrets.NAMES] for k in expected], float)
    votes = sum(tree.shares(table_) for tree in forest) / len(forest)
    answer = {(r.doc_id, r.place): r for r in QUERIES["op7_secret_forest"](spark, SF).collect()}
    assert answer.keys() == expected.keys()
    for key, vote in zip(expected, votes, strict=True):
        r = answer[key]
        assert r.candidate == expected[key][0] and r.score == pytest.approx(vote, abs=1e-4)
        assert r.secret == (r.score >= 0.5)


UNBROKEN = {
    "colons": "a:", "hex": "00:01:02:0a:", "equals": "=", "quotes": '"', "single": "'", "escapes": "\\", "paths": "//a:",
    "at": "//u:p@", "dashes": "-", "names": "key key_", "spaced": "= ", "blanks": " ", "ands": "a=b&",
}


@pytest.mark.parametrize("kind", sorted(UNBROKEN))
def test_a_megabyte_takes_seconds(spark, forest, kind):
    unit = UNBROKEN[kind]
    df = spark.createDataFrame([((unit * 1_000_000)[:1_000_000],)], "text string").select("text", F.lit(1).alias("n"))
    scanned = secrets.scan(df, forest).select(F.length("redacted"))
    begin = time.perf_counter()
    assert scanned.first()[0] == 1_000_000
    assert time.perf_counter() - begin < 12  # with the compilation of the plan; about 1.5 s alone


@pytest.mark.parametrize("unit", ["password=", "token:", "token:abc", 'password=\\"a\\b', "password=a&b=c", "a:a@", 'password="'])
def test_time_grows_with_the_text(spark, forest, unit):
    def seconds(n: int) -> float:
        df = spark.createDataFrame([((unit * n)[:n],)], "text string")
        scanned = secrets.scan(df, forest).select(F.size("findings"))
        scanned.first()
        begin = time.perf_counter()
        scanned.first()
        return time.perf_counter() - begin

    # Four times the text: quadratic work would be sixteen times as much.
    assert seconds(200_000) < 8 * max(seconds(50_000), 0.25)


def test_odd_userinfo_and_values(spark, forest):
    texts = {
        "postgres://bob:S3:cr:et:Pw:99:x:y@db/x": "S3:cr:et:Pw:99:x:y",
        "login bob:S3cretPw99@db now": "S3cretPw99",
        'password = "a=b:c=d9X"': "a=b:c=d9X",
        "password=Zk93=hQp:Lw82xTn next": "Zk93=hQp:Lw82xTn",
    }
    made = secrets.with_candidates(spark.createDataFrame([(t,) for t in texts], "text string")).collect()
    assert {r.text: r["_runs"] for r in made} == {t: [c] for t, c in texts.items()}
