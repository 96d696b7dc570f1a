import json
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import validate
from tidemark.operators.validate import accepted, dead_letters, validate_events
from tidemark.sources.files import keyed_messages

GOOD = {
    "timestamp": 1, "dataset_id": "ds_000001", "reads_1h": 150, "writes_1h": 2, "bytes_read_1h": 1024, "hour_of_day": 12,
    "day_of_week": 2, "current_backend": "public-cold", "initial_backend": "public-hot", "size_gb": 25.0,
}


def changed(**kw):
    return json.dumps({**GOOD, **kw})


def without(*names):
    return json.dumps({k: v for k, v in GOOD.items() if k not in names})


CASES = [
    (json.dumps(GOOD), None),
    ("  " + json.dumps(GOOD) + "\n", None),
    (json.dumps(GOOD) + " x", "invalid json"),
    (json.dumps(GOOD) + "," + json.dumps(GOOD), "invalid json"),
    (json.dumps(GOOD) + "] garbage", "invalid json"),
    (json.dumps(GOOD) + "],[1", "invalid json"),
    (json.dumps(GOOD) + "]", "invalid json"),
    (json.dumps(GOOD) + "}", "invalid json"),
    (json.dumps(GOOD) + "] {}", "invalid json"),
    (json.dumps({**GOOD, "tags": [1, "]"]}), None),
    ("", "invalid json"),
    ("nope", "invalid json"),
    (json.dumps(GOOD)[:-1], "invalid json"),
    ("[1]", "event must be object"),
    ("null", "event must be object"),
    ('"text"', "event must be object"),
    ("7", "event must be object"),
    (without("dataset_id"), "missing field: dataset_id"),
    (without("size_gb"), "missing field: size_gb"),
    (without("timestamp", "dataset_id"), "missing field: timestamp"),
    (changed(reads_1h=None), "invalid type for reads_1h"),
    (changed(reads_1h="5"), "invalid type for reads_1h"),
    (changed(reads_1h=2.0), "invalid type for reads_1h"),
    (changed(reads_1h=2**70), "invalid type for reads_1h"),
    (changed(dataset_id=5), "invalid type for dataset_id"),
    (changed(size_gb="5"), "invalid type for size_gb"),
    (changed(writes_1h=[1]), "invalid type for writes_1h"),
    (changed(reads_1h=-1), "negative metrics not allowed"),
    (changed(writes_1h=-1), "negative metrics not allowed"),
    (changed(size_gb=-0.5), "negative metrics not allowed"),
    (changed(reads_1h=-1, hour_of_day=24), "negative metrics not allowed"),
    (changed(hour_of_day=24), "hour_of_day out of range"),
    (changed(hour_of_day=-1), "hour_of_day out of range"),
    (changed(day_of_week=7), "day_of_week out of range"),
    (changed(day_of_week=-1), "day_of_week out of range"),
    (changed(bytes_read_1h=-5), None),
    (changed(current_backend="tape"), None),
    (changed(dataset_id=""), None),
    (changed(writes_1h=True), None),
    (changed(size_gb=3), None),
    (changed(size_gb=1e3), None),
    (changed(extra={"a": 1}), None),
    (without("initial_backend"), None),
    (changed(initial_backend=None), None),
]


@pytest.fixture(scope="module")
def checked(spark):
    raw = spark.createDataFrame([(i, text) for i, (text, _) in enumerate(CASES)], "seq long, value string")
    return validate_events(raw)


def test_first_broken_rule_names_the_error(checked):
    got = {r["seq"]: (r["error"], r["valid"]) for r in checked.collect()}
    assert {i: got[i] for i in got} == {i: (e, e is None) for i, (_, e) in enumerate(CASES)}


def test_every_event_is_either_accepted_or_a_dead_letter(checked):
    dead = dead_letters(checked, 5.0).collect()
    assert accepted(checked).count() + len(dead) == len(CASES)
    assert {r["payload"] for r in dead} == {t for t, e in CASES if e}
    assert {r["ts"] for r in dead} == {5.0}


def test_typed_values(checked):
    rows = {r["seq"]: r for r in checked.collect()}
    good = rows[0]
    assert {k: good[k] for k in GOOD} == GOOD
    at = lambda text: rows[[t for t, _ in CASES].index(text)]
    assert at(changed(writes_1h=True))["writes_1h"] == 1
    assert at(changed(size_gb=3))["size_gb"] == 3.0
    assert at(without("initial_backend"))["initial_backend"] == "public-cold"
    assert at(changed(initial_backend=None))["initial_backend"] is None


def mutated(rng, text):
    """A text with a few small changes: characters dropped, doubled, swapped for others that matter in JSON."""
    for _ in range(rng.randrange(1, 4)):
        i = rng.randrange(len(text))
        c = rng.choice(['"', ",", ":", "{", "}", "[", "]", " ", "\\", "0", "1", ".", "-", "e", "null", "true", '"x":1', ',"x":"y"', "NaN", "'"])
        text = rng.choice([text[:i] + text[i + 1:], text[:i] + c + text[i:], text[:i] + c + text[i + 1:], text[:i] + text[i] + text[i:]])
    return text


def test_quick_and_careful_reading_agree(spark, monkeypatch):
    """Whatever the quick reader vouches for, the careful one reads the same."""
    rng = random.Random(5)
    spaced, tight = json.dumps(GOOD), json.dumps(GOOD, separators=(",", ":"))
    without_initial = json.dumps({k: v for k, v in GOOD.items() if k != "initial_backend"}, separators=(",", ":"))
    texts = [t for t, _ in CASES] + [json.dumps(json.loads(t), separators=(",", ":")) for t, e in CASES if e is None]
    texts += [json.dumps({**GOOD, "dataset_id": 5, "x": 1}), json.dumps({**GOOD, "dataset_id": {"a": 1}}), without_initial[:-1] + ',"x":1}',
              tight[:-1] + ',"reads_1h":7}', json.dumps({**GOOD, "initial_backend": 5}), json.dumps({**GOOD, "size_gb": float("inf")}),
              tight.replace("25.0", "1e999"), tight.replace("25.0", "-0.0"), tight.replace("150", "9223372036854775808"), tight.replace(":12,", ":2147483648,")]
    texts += [mutated(rng, rng.choice([spaced, tight, without_initial])) for _ in range(3000)]
    raw = spark.createDataFrame(list(enumerate(texts)), "seq long, value string").repartition(8, "seq")
    quick = {r.seq: tuple(r) for r in validate_events(raw).collect()}
    monkeypatch.setattr(validate, "_quick", lambda text, read: F.lit(False))
    careful = {r.seq: tuple(r) for r in validate_events(raw).collect()}
    names = validate_events(raw).columns
    valid = names.index("valid")
    # Fields of a rejected event are not used.
    cut = lambda row: row if row[valid] else row[: names.index("error") + 1]
    assert {k: cut(v) for k, v in quick.items()} == {k: cut(v) for k, v in careful.items()}
    assert sum(v[valid] for v in careful.values()) > 100


def test_publishing_and_reading_again_changes_nothing(checked, spark):
    """Encode, then validate: an explicit null is not the same as a missing field."""
    kept = accepted(checked)
    again = validate_events(keyed_messages(kept.drop("seq")).select("value"))
    assert again.filter("not valid").count() == 0
    names = [c for c in kept.columns if c != "seq"]
    assert sorted(map(repr, accepted(again).select(names).collect())) == sorted(map(repr, kept.select(names).collect()))
    assert kept.filter("initial_backend is null").count() == 1
