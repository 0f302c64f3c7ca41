import datetime
import json
import random

import pytest

from ledgerline.streaming import incremental, keyed

PLAIN = "k string, pos long, v string"
TIMED = "k string, at timestamp, pos long, v string"


@pytest.fixture(scope="module")
def stateful(spark):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", keyed.PROVIDER)
    yield spark
    spark.conf.unset("spark.sql.streaming.stateStore.providerClass")


def land(folder, number, rows):
    folder.mkdir(exist_ok=True)
    (folder / f"{number:03d}.json").write_text("".join(json.dumps(r) + "\n" for r in rows))


def told(table):
    return {r.k: (r.pos, r[-1]) for r in table.collect()}


def test_three_batches_give_the_answer_of_one(stateful, tmp_path):
    draw, rows = random.Random(4), []
    for i in range(600):
        rows.append({"k": draw.choice([None, *(f"k{j}" for j in range(60))]), "pos": draw.choice([None, *range(20 * i, 20 * i + 15)]) if i % 7 else i, "v": f"v{i}"})
    draw.shuffle(rows)  # late rows in every batch
    source = tmp_path / "in"
    for n in range(3):
        land(source, n, rows[n::3])
    stream = lambda: stateful.readStream.schema(PLAIN).option("maxFilesPerTrigger", 1).json(str(source))
    run = lambda: keyed.run(stream(), str(tmp_path / "out"), str(tmp_path / "ck"), "k", "pos", buckets=4)
    best = {}
    for r in rows:
        if r["k"] is not None and r["pos"] is not None and r["pos"] > best.get(r["k"], (-1, ""))[0]:
            best[r["k"]] = (r["pos"], r["v"])
    got = run()
    assert told(got) == best and got.count() == len(best)
    # Begun again with new files: the state goes on where it stopped, older positions change nothing.
    land(source, 3, [{"k": "k1", "pos": 0, "v": "old"}, {"k": "k2", "pos": 10**9, "v": "new"}, {"k": "fresh", "pos": 1, "v": "first"}, {"k": "fresh", "pos": 1, "v": "second"}])
    assert told(run()) == best | {"k2": (10**9, "new"), "fresh": (1, "first")}
    assert told(run()) == told(incremental.read_buckets(stateful, str(tmp_path / "out"), PLAIN))


def test_a_batch_broken_off_while_it_is_written_is_repeated(stateful, tmp_path, monkeypatch):
    source, calls, real = tmp_path / "in", [], keyed.upsert_buckets
    for n in range(3):
        land(source, n, [{"k": f"k{j}", "pos": (7 * n + j) % 10, "v": f"{n}:{j}"} for j in range(12)])

    def breaks(*args):
        calls.append(1)
        done = real(*args)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return done

    monkeypatch.setattr(keyed, "upsert_buckets", breaks)
    run = lambda: keyed.run(stateful.readStream.schema(PLAIN).option("maxFilesPerTrigger", 1).json(str(source)), str(tmp_path / "out"), str(tmp_path / "ck"), "k", "pos", buckets=4)
    with pytest.raises(Exception, match="lost"):
        run()
    want = {f"k{j}": max(((7 * n + j) % 10, f"{n}:{j}") for n in range(3)) for j in range(12)}
    assert told(run()) == want and len(calls) == 4


def test_state_goes_when_the_watermark_has_passed(stateful, tmp_path):
    source, day = tmp_path / "in", lambda d, h=0: (datetime.datetime(2024, 1, d, h)).isoformat() + "Z"
    land(source, 0, [{"k": "a", "at": day(1), "pos": 5, "v": "a1"}, {"k": "b", "at": day(1), "pos": 1, "v": "b1"}])
    land(source, 1, [{"k": "a", "at": day(1), "pos": 9, "v": "a2"}, {"k": "c", "at": day(10), "pos": 1, "v": "c1"}, {"k": None, "at": day(1), "pos": 9, "v": "-"}, {"k": "a", "at": None, "pos": 99, "v": "-"}])
    land(source, 2, [{"k": "b", "at": day(2), "pos": 9, "v": "too late"}, {"k": "c", "at": day(9, 12), "pos": 50, "v": "older"}, {"k": "b", "at": day(10), "pos": 0, "v": "b2"}])
    land(source, 3, [{"k": "c", "at": day(10), "pos": 2, "v": "c2"}])
    stream = stateful.readStream.schema(TIMED).option("maxFilesPerTrigger", 1).json(str(source))
    got = keyed.run(stream.withColumnRenamed("v", "_v x"), str(tmp_path / "out"), str(tmp_path / "ck"), "k", "pos", "at", "1 day", 4)
    assert got.columns == ["k", "at", "pos", "_v x"]
    assert told(got) == {"a": (9, "a2"), "b": (0, "b2"), "c": (2, "c2")}
    state = stateful.read.format("statestore").option("path", str(tmp_path / "ck")).option("stateVarName", "lead").load()
    assert {r[0] for r in state.select("key.grouped").collect()} == {"b", "c"}


def test_a_batch_asks_for_shelves_and_not_for_keys(stateful, tmp_path):
    """400 keys on 8 shelves: the state has 8 entries at most, which hold each key's position."""
    source, run = tmp_path / "in", lambda: keyed.run(stateful.readStream.schema(PLAIN).json(str(source)), str(tmp_path / "out"), str(tmp_path / "ck"), "k", "pos", buckets=4, shelves=8)
    land(source, 0, [{"k": f"k{j}", "pos": j, "v": "one"} for j in range(400)])
    run()
    land(source, 1, [{"k": f"k{j}", "pos": 200, "v": "two"} for j in range(0, 500, 2)])
    best = {f"k{j}": (j, "one") for j in range(400)} | {f"k{j}": (200, "two") for j in range(0, 500, 2) if j < 200 or j >= 400}
    assert told(run()) == best
    state = stateful.read.format("statestore").option("path", str(tmp_path / "ck")).option("stateVarName", "lead").load().select("value.*").collect()
    assert len(state) <= 8
    assert {k: p for r in state for k, p in zip(r["keys"], r.pos)} == {k: p for k, (p, _) in best.items()}
    with pytest.raises(ValueError, match="other parameters"):
        keyed.run(stateful.readStream.schema(PLAIN).json(str(source)), str(tmp_path / "out"), str(tmp_path / "ck"), "k", "pos", buckets=4, shelves=9)


def test_keys_of_any_type_lie_on_shelves(stateful, tmp_path):
    stream = lambda: stateful.readStream.schema("x double, pos long").json(str(tmp_path / "in")).selectExpr("named_struct('b', cast(x as string), 'a', array(x)) AS k", "x + 0D AS d", "pos")
    land(tmp_path / "in", 0, [{"x": 1.5, "pos": 1}, {"x": "NaN", "pos": 5}, {"x": -0.0, "pos": 3}, {"x": 1.5, "pos": 0}])
    run = lambda key: {str(r[key]): r.pos for r in keyed.run(stream().select(key, "pos"), str(tmp_path / f"out{key}"), str(tmp_path / f"ck{key}"), key, "pos", buckets=2).collect()}
    assert list(run("k").values()).count(1) == 1 and run("d")["nan"] == 5
    land(tmp_path / "in", 1, [{"x": "NaN", "pos": 4}, {"x": 1.5, "pos": 2}, {"x": -0.0, "pos": 2}])
    assert sorted(run("k").values()) == [2, 3, 5] and run("d") == {"1.5": 2, "nan": 5, "0.0": 3}


def test_the_state_store_must_hold_keyed_state(spark, tmp_path):
    spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    with pytest.raises(ValueError, match="providerClass"):
        keyed.leaders(spark.createDataFrame([], PLAIN), "k", "pos")
