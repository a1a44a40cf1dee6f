"""Undeclared nested records against a plain walk of the same JSON."""

import json
import random

import pytest

from aerostage.operators import variant


def walk(record, keys, default=None):
    at = record
    for k in keys:
        if not isinstance(at, dict) or k not in at:
            return default
        at = at[k]
    return at


def flat(record, head=()):
    out = {}
    for k, v in record.items():
        out |= flat(v, (*head, k)) if isinstance(v, dict) else {(*head, k): v}
    return out


def some(r, depth=0):
    kinds = ["null", "text", "number", "flag", "list"] + ["object"] * (3 if depth < 3 else 0)
    out = {}
    for k in r.sample(["a", "b", "c.d", "e f", "it's", "ü"], r.randrange(0, 5)):
        kind = r.choice(kinds)
        out[k] = {"null": None, "text": r.choice(["x", "", "0"]), "number": r.randrange(50), "flag": r.random() < 0.5, "list": [1, "y", None],
                  "object": None}[kind] if kind != "object" else some(r, depth + 1)
    return out


def shown(v):
    if v is None or isinstance(v, str):
        return v
    return json.dumps(v, separators=(",", ":"))


@pytest.fixture(scope="module")
def records(spark):
    r = random.Random(4)
    rows = [some(r) for _ in range(200)]
    texts = [json.dumps(x, ensure_ascii=False) for x in rows] + ["broken {", None, "[1]", "5", "{}"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string").select("id", variant.parse("text").alias("v"))
    return rows + [{}] * 5, df


def test_present_nulls_and_missing_keys(records):
    rows, df = records
    paths = [("a",), ("a", "b"), ("c.d",), ("it's", "a"), ("ü", "e f", "a")]
    got = df.select("id", *[variant.get_path("v", p, default="none").alias(f"p{i}") for i, p in enumerate(paths)]).collect()
    for x in got:
        for i, p in enumerate(paths):
            assert x[f"p{i}"] == shown(walk(rows[x["id"]], p, "none")) or isinstance(walk(rows[x["id"]], p), dict)


def test_flattened_to_the_union_of_keys(records):
    rows, df = records
    out = variant.flatten_unknown(df, "v", ["id"])
    names = {}
    for x in rows:
        for p in flat(x):
            names.setdefault("_".join(p), set()).add(p)
    assert out.columns == ["id", *sorted(names)] and max(p.count("_") for p in names) >= 2
    for x in out.collect():
        own = flat(rows[x["id"]])
        for name, paths in names.items():
            values = [own[p] for p in sorted(paths) if p in own]
            assert x[name] == shown(next((v for v in values if v is not None), None))


def test_no_records(spark):
    df = spark.createDataFrame([], "id int, text string").select("id", variant.parse("text").alias("v"))
    assert variant.flatten_unknown(df, "v", ["id"]).columns == ["id"]


def test_one_pass_finds_the_keys_of_four_levels(spark, monkeypatch):
    texts = ['{"a": {"b": {"c": {"d": 1}, "e": {}}, "f": [{"g": 1}]}, "h": null}', '{"a": 5}', '{"a": {"b": "x"}}', '[{"k": 1}]', "{}", "broken {", None]
    deep = '{"p": {"q": {"r": {"s": {"t": {"u": true}}, "w": 2}}}}'
    passes = []
    collect = type(spark.range(1)).collect
    monkeypatch.setattr(type(spark.range(1)), "collect", lambda df: passes.append(df) or collect(df))
    of = lambda rows: variant.leaf_paths(spark.createDataFrame([(t,) for t in rows], "text string").select(variant.parse("text").alias("v")), "v")
    four = [("a",), ("a", "b"), ("a", "b", "c", "d"), ("a", "f"), ("h",)]
    assert of(texts) == four and len(passes) == 1
    assert of([*texts, deep]) == [*four, ("p", "q", "r", "s", "t", "u"), ("p", "q", "r", "w")] and len(passes) == 3
