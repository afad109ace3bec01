import base64
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quern.llm import media


def image(seed, sampling, width, height, interval=0):
    """Random coefficients, and the thumbnail that they must give."""
    rng = np.random.default_rng(seed)
    hmax, vmax = max(h for h, _ in sampling), max(v for _, v in sampling)
    across, down = -(-width // (8 * hmax)), -(-height // (8 * vmax))
    one = len(sampling) == 1
    blocks = [np.where(rng.random((down * (1 if one else v), across * (1 if one else h), 64)) < 0.2, rng.integers(-60, 60, (down * (1 if one else v), across * (1 if one else h), 64)), 0) for h, v in sampling]
    quant = rng.integers(1, 20, 64)
    raw = media.encode(blocks, width, height, sampling, quant, interval)
    rows, cols = -(-height // 8), -(-width // 8)
    return raw, np.clip(np.floor(blocks[0][:rows, :cols, 0] * quant[0] / 8 + 128.5), 0, 255).astype(np.uint8)


@pytest.mark.parametrize("sampling", [[(1, 1)], [(1, 1)] * 3, [(2, 2), (1, 1), (1, 1)], [(2, 1), (1, 1), (1, 1)], [(1, 2), (1, 1), (1, 1)]])
@pytest.mark.parametrize("interval", [0, 3])
def test_dc_is_read_back(sampling, interval):
    for seed, (w, h) in enumerate([(64, 64), (8, 8), (1, 1), (37, 91), (200, 16)]):
        raw, want = image(seed, sampling, w, h, interval)
        width, height, components, thumb = media.decode_dc(raw)
        assert (width, height, components) == (w, h, len(sampling))
        assert np.array_equal(thumb, want)


def inverse(block):
    c = [[math.sqrt(1 / 8) if u == 0 else 0.5 * math.cos((2 * x + 1) * u * math.pi / 16) for u in range(8)] for x in range(8)]
    return np.array(c) @ block.reshape(8, 8) @ np.array(c).T + 128


def test_dc_is_the_mean_of_the_full_decoding():
    rng = np.random.default_rng(4)
    coefficients = rng.integers(-5, 5, (2, 3, 64))
    coefficients[..., 0] = rng.integers(-30, 30, (2, 3))
    thumb = media.decode_dc(media.encode([coefficients], 24, 16, [(1, 1)], np.full(64, 3)))[3]
    means = np.array([[inverse(coefficients[y, x] * 3.0).mean() for x in range(3)] for y in range(2)])
    assert np.abs(thumb - means).max() <= 0.5 + 1e-9


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 10**6), st.integers(0, 255), st.booleans())
def test_damage_is_reported_or_harmless(at, byte, cut):
    raw, _ = image(1, [(1, 1)] * 3, 40, 24)
    at %= len(raw)
    bad = raw[:at] if cut else raw[:at] + bytes([byte]) + raw[at + 1 :]
    try:
        media.decode_dc(bad)
    except media.BadJpeg:
        pass


def separate_scans(seed, sampling, width, height, order):
    """A JPEG with a scan for each component, in the given order, and the thumbnail that it must give."""
    rng = np.random.default_rng(seed)
    hmax, vmax = max(h for h, _ in sampling), max(v for _, v in sampling)
    quant, grey = np.full(64, 4), []
    for h, v in sampling:
        w, t = -(-width * h // hmax), -(-height * v // vmax)
        blocks = rng.integers(-50, 50, (-(-t // 8), -(-w // 8), 64)) * (rng.random((-(-t // 8), -(-w // 8), 64)) < 0.3)
        grey.append((media.encode([blocks], w, t, [(1, 1)], quant), blocks))
    raw = grey[0][0]
    frame, scan = raw.index(b"\xff\xc0"), raw.index(b"\xff\xda")
    n = len(sampling)
    out = raw[:frame] + b"\xff\xc0" + (8 + 3 * n).to_bytes(2, "big") + b"\x08" + height.to_bytes(2, "big") + width.to_bytes(2, "big") + bytes([n]) + b"".join(bytes([i + 1, h << 4 | v, 0]) for i, (h, v) in enumerate(sampling)) + raw[frame + 13 : scan]
    for i in order:
        part = grey[i][0]
        out += b"\xff\xda\x00\x08\x01" + bytes([i + 1]) + part[part.index(b"\xff\xda") + 6 : -2]
    return out + b"\xff\xd9", np.clip(np.floor(grey[0][1][..., 0] * 4 / 8 + 128.5), 0, 255).astype(np.uint8)


@pytest.mark.parametrize("order", [[0, 1, 2], [2, 1, 0], [1, 0, 2]])
@pytest.mark.parametrize("sampling", [[(1, 1)] * 3, [(2, 2), (1, 1), (1, 1)], [(2, 1), (1, 1), (1, 1)]])
def test_a_scan_for_each_component(order, sampling):
    for seed, (w, h) in enumerate([(64, 64), (37, 91), (9, 5)]):
        raw, want = separate_scans(seed, sampling, w, h, order)
        assert media.decode_dc(raw)[:3] == (w, h, 3) and np.array_equal(media.decode_dc(raw)[3], want)


def test_a_foreign_file():
    """One white pixel, made by another encoder with tables of its own."""
    raw = base64.b64decode("/9j/4AAQSkZJRgABAQEAYABgAAD/2wBDAAgGBgcGBQgHBwcJCQgKDBQNDAsLDBkSEw8UHRofHh0aHBwgJC4nICIsIxwcKDcpLDAxNDQ0Hyc5PTgyPC4zNDL/wAALCAABAAEBAREA/8QAFAABAAAAAAAAAAAAAAAAAAAACf/EABQQAQAAAAAAAAAAAAAAAAAAAAD/2gAIAQEAAD8AVN//2Q==")
    width, height, components, thumb = media.decode_dc(raw)
    assert (width, height, components, thumb.tolist()) == (1, 1, 1, [[255]])


def test_a_scan_is_laid_out_in_parts(monkeypatch):
    raw, want = image(3, [(1, 1)] * 3, 200, 300)
    monkeypatch.setattr(media, "_AHEAD", 700)
    assert np.array_equal(media.decode_dc(raw)[3], want)


def test_hash_of_near_images():
    rng = np.random.default_rng(0)
    a = np.add.outer(np.arange(16) * 9, rng.integers(0, 90, 16)).astype(np.uint8)
    b = np.clip(a.astype(int) + 1, 0, 255).astype(np.uint8)
    distance = lambda x, y: bin((media.thumb_hash(x) ^ media.thumb_hash(y)) & (2**64 - 1)).count("1")
    assert distance(a, b) <= 4 and distance(a, a[:, ::-1]) > 20
    assert media.thumb_hash(np.zeros((1, 1), np.uint8)) == 0


def test_odd_rows(spark):
    good, want = image(2, [(2, 2), (1, 1), (1, 1)], 50, 30)
    progressive = good.replace(b"\xff\xc0", b"\xff\xc2", 1)
    rows = [(1, good, "x"), (1, good, "x"), (2, b"", "x"), (3, None, "x"), (None, good, "x"), (4, b"GIF89a", "x"), (5, progressive, "x"), (6, good[:-30], "x")]
    df = spark.createDataFrame(rows, "id BIGINT, image BINARY, width STRING")
    got = media.with_thumbnails(df).collect()
    assert len(got) == len(rows)
    by = {r["id"]: r for r in got}
    assert (by[1]["width"], by[1]["height"], by[1]["components"], by[1]["error"]) == (50, 30, 3, None)
    assert bytes(by[1]["thumb"]) == want.tobytes() == bytes(by[None]["thumb"]) and by[1]["thumb_width"] * by[1]["thumb_height"] == want.size
    assert by[3]["error"] is None and by[3]["width"] is None
    assert all(by[i]["error"] and by[i]["thumb"] is None for i in (2, 4, 5, 6)) and by[5]["error"] == "not baseline"
    assert media.with_thumbnails(df.limit(0)).count() == 0


def test_query_gives_each_vector_its_image(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    images = {r["vec_id"]: bytes(r["image"]) for r in media.rendered(df).collect()}
    vectors = {r["vec_id"]: np.array(r["embedding"], float) for r in df.collect()}
    for r in media.with_thumbnails(media.rendered(df), id_col="vec_id").collect():
        assert r["error"] is None and (r["width"], r["height"]) == (64, 64)
        want = np.clip(np.clip(np.round(vectors[r["vec_id"]] * media._GAIN), -127, 127) + 128, 0, 255).astype(np.uint8)
        assert bytes(r["thumb"]) == want.tobytes()
        assert images[r["vec_id"]][:2] == b"\xff\xd8" and media.thumb_hash(want.reshape(r["thumb_height"], r["thumb_width"])) == r["thumb_hash"]
