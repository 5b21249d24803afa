"""Large documents read by ranges against the reader of whole documents."""

import json
import random

import pytest

from mapweave.sources import geojson, json_ranges

HARD = ['a"b', "back\\slash", 'q\\"', "{[,]}", "\\\\", "ü€𝄞", '"features":[', "\n\t", "\\u0041", ""]


def collection(rng, n, before=True):
    def value(d):
        kind = rng.randrange(6)
        if kind == 0 and d < 4:
            return {rng.choice(HARD): value(d + 1) for _ in range(rng.randrange(3))}
        if kind == 1 and d < 4:
            return [value(d + 1) for _ in range(rng.randrange(3))]
        return rng.choice([*HARD, 1.5, -3, True, None])

    features = [{"type": "Feature", "id": i, "properties": {"p": value(0), "features": [1]}, "geometry": {"type": "Point", "coordinates": [i, 2]}} for i in range(n)]
    members = {"type": "FeatureCollection", "links": [{"features": [2], "x": "]"}], "name": rng.choice(HARD)}
    root = {**members, "features": features, "after": {"b": ["}", 1]}} if before else {"features": features, **members}
    return json.dumps(root, ensure_ascii=rng.random() < 0.5, indent=rng.choice([None, None, 1]))


@pytest.fixture
def tiny(monkeypatch):
    def set_to(length, block):
        monkeypatch.setattr(json_ranges, "RANGE", length)
        monkeypatch.setattr(json_ranges, "BLOCK", block)
        monkeypatch.setattr(geojson, "LARGE", 0)

    return set_to


@pytest.mark.parametrize("length, block", [(1, 1), (3, 2), (17, 5), (64, 1000), (1000, 33)])
def test_states_and_elements(tmp_path, tiny, length, block):
    """Ranges of any size, composed here by hand, give every element once."""
    tiny(length, block)
    rng = random.Random(length)
    for k in range(8 if length > 1 else 3):
        path = tmp_path / f"{k}.json"
        path.write_text(collection(rng, rng.randrange(6), k % 2 == 0), encoding="utf-8")
        name, size = str(path), path.stat().st_size
        quoted = depth = 0
        states, opens, closes = [], [], []
        for start in range(0, size, length):
            end = min(start + length, size)
            states.append((start, end, quoted, depth))
            parity, *rest = json_ranges.effect(name, start, end)
            o, c = json_ranges.array_places(name, start, end, quoted, depth)
            assert not (o or c) or depth + rest[2 * quoted + 1] <= 1 or depth <= 1
            opens += o
            closes += c
            depth += rest[2 * quoted]
            quoted ^= parity
        assert (quoted, depth) == (0, 0) and len(opens) == 1
        last = min(c for c in closes if c > opens[0])
        found = [p for s in states for p in json_ranges.elements(name, *s, opens[0], last)]
        assert found == list(geojson.split_document(geojson._chunks(name), True))


def test_equal_to_whole_documents(spark, tmp_path, tiny):
    rng = random.Random(9)
    texts = [collection(rng, 40), collection(rng, 25, False), '{"type":"Feature","geometry":null,"properties":{"a":1}}']
    texts += ['{"type":"FeatureCollection","features":[ ],"title":"t"}', '{"type":"FeatureCollection","features":[]}', ' \n{ "features" \n : \n [{"type":"Feature","geometry":null,"properties":{}} , ] , "type" : "FeatureCollection"} ']
    paths = []
    for i, text in enumerate(texts):
        (tmp_path / f"{i}.json").write_text(text, encoding="utf-8")
        paths.append(str(tmp_path / f"{i}.json"))
    want = sorted((tuple(r) for r in geojson.document_features(spark, paths, "AUTO").collect()), key=repr)
    tiny(200, 64)
    rows = geojson.document_features(spark, paths, "AUTO")
    assert sorted((tuple(r) for r in rows.collect()), key=repr) == want and len(want) > 60
    assert geojson.read_geojson(spark, paths).count() == sum(r[2] is not None for r in want)


@pytest.mark.parametrize("text", ['{"type":"FeatureCollection","features":[1]}', '{"type":"FeatureCollection","features":[{},,{}]}', '{"type":"FeatureCollection","features":[{}', '{"type":"Feature","features":[]}', '{"type":"FeatureCollection","features":[]} x', "[]", '{"type":"FeatureCollection"}'])
def test_wrong_documents_fail(spark, tmp_path, tiny, text):
    path = tmp_path / "a.json"
    path.write_text(text)
    tiny(7, 3)
    with pytest.raises(Exception, match="JSON|array|object|Expected"):
        geojson.document_features(spark, [str(path)], "AUTO").collect()


def test_one_document_uses_many_tasks(spark, tmp_path, tiny):
    path = tmp_path / "big.json"
    path.write_text(collection(random.Random(1), 3000))
    tiny(path.stat().st_size // 10, 4096)
    rows = geojson.document_features(spark, [str(path)], "AUTO")
    per_task = rows.rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect()
    assert sum(per_task) == 3000 and sum(n > 0 for n in per_task) >= 8
