import hashlib
import io
import math
import wave

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxloom.functions import signal as S


def wav(x, rate=16_000, channels=1):
    b = io.BytesIO()
    with wave.open(b, "wb") as f:
        f.setnchannels(channels)
        f.setsampwidth(2)
        f.setframerate(rate)
        f.writeframes((np.asarray(x) * 32767).astype("<i2").tobytes())
    return b.getvalue()


SINE = [0.1 * math.sin(2 * math.pi * 220 * i / 16_000) for i in range(16_000)]


def test_decoding(spark):
    df = spark.createDataFrame([(wav(SINE),), (b"RIFFjunk",), (None,), (wav(np.repeat(SINE, 2), 8_000, 2),)], "b binary")
    got = [r.d for r in df.select(S.decoded(F.col("b")).alias("d")).collect()]
    assert (len(got[0].samples), got[0].sample_rate, got[0].channels, got[0].error) == (16_000, 16_000, 1, None)
    assert got[1].error and got[2].error and got[1].samples is None
    assert (len(got[3].samples), got[3].sample_rate, got[3].channels) == (16_000, 8_000, 2)


def measured(spark, w):
    c = F.col("w")
    return spark.createDataFrame([(w,)], "w array<float>").select(
        S.peak(c).alias("peak"), S.rms(c).alias("rms"), S.decibels(S.rms(c)).alias("db"), S.clipping_fraction(c).alias("clip"),
        S.edge_silence(c, F.lit(4)).alias("edge"), S.is_valid(c, F.lit(4)).alias("valid"), S.seconds(c, F.lit(4)).alias("s"),
    ).first()


def test_measures(spark):
    r = measured(spark, [0.0, 0.5, -1.0, 0.0])
    assert (r.peak, r.clip, r.valid, r.s) == (1.0, 0.25, True, 1.0) and abs(r.rms - math.sqrt(1.25 / 4)) < 1e-9
    assert (r.edge.leading, r.edge.trailing, r.edge.threshold) == (0.25, 0.25, 0.01)


def test_silence_and_emptiness(spark):
    r = measured(spark, [0.0, 0.0])
    assert (r.edge.leading, r.edge.trailing, r.edge.threshold, r.db) == (0.5, 0.5, 0.0, -240.0)
    r = measured(spark, [])
    assert r.rms is None and not r.valid and r.edge.threshold == 0.0
    assert not measured(spark, [float("nan")]).valid and not measured(spark, [float("inf")]).valid


def test_downmix_layouts(spark):
    df = spark.createDataFrame([([[1.0, 0.0], [0.0, 1.0], [1.0, 1.0]],), ([[1.0, 0.0, 1.0], [0.0, 0.0, 1.0]],), ([],)], "f array<array<double>>")
    assert [r.m for r in df.select(S.downmix(F.col("f")).alias("m")).collect()] == [[0.5, 0.5, 1.0], [0.5, 0.0, 1.0], []]


def test_trim_rounds_halves_to_even(spark):
    df = spark.createDataFrame([(list(range(10)),)], "w array<int>")
    assert df.select(S.trimmed(F.col("w"), F.lit(0.5), F.lit(2.5), 1).alias("t")).first().t == [0, 1]


def test_signed_bytes(spark):
    values = [-128, -1, 0, 127]
    df = spark.createDataFrame([(values,), ([],), (None,)], "v array<tinyint>")
    want = bytes(x & 255 for x in values)
    rows = df.select(S.signed_to_binary(F.col("v")).alias("a"), S.signed_to_binary_long(F.col("v")).alias("b"), S.bytes_fingerprint(S.signed_to_binary(F.col("v"))).alias("h")).collect()
    assert bytes(rows[0].a) == bytes(rows[0].b) == want and rows[0].h == hashlib.sha256(want).hexdigest() and bytes(rows[1].b) == b"" and rows[2].b is None


def test_sample_fingerprint(spark):
    df = spark.createDataFrame([([0.5, -0.5],)], "w array<float>")
    want = hashlib.sha256(b"16000" + np.array([0.5, -0.5], "<f4").tobytes()).hexdigest()
    assert df.select(S.sample_fingerprint(F.col("w"), F.lit(16_000)).alias("h")).first().h == want


@pytest.mark.parametrize("rate", [8_000, 16_000, 22_050, 44_100, 48_000])
def test_resampling_keeps_a_tone(rate):
    x = np.sin(2 * np.pi * 440 * np.arange(rate) / rate)
    y = S.resample(x, rate)
    want = np.sin(2 * np.pi * 440 * np.arange(16_000) / 16_000)
    assert len(y) == 16_000 and np.abs(y - want)[200:-200].max() < 0.01


def test_preparation(spark):
    df = spark.createDataFrame([(wav(SINE * 3), 0.5, 2.0), (wav(SINE * 3), None, None), (wav(SINE[:10]), None, None), (None, None, None)], "b binary, s double, e double")
    got = [r.p for r in df.select(S.prepared(F.col("b"), F.col("s"), F.col("e")).alias("p")).collect()]
    assert [g.audio_size for g in got] == [24_000, 48_000, None, None] and got[2].error.startswith("ValueError") and got[3].error
    frames, rate, _ = S.decode_wav(np.array(got[0].audio_bytes, np.int8).tobytes())
    assert rate == 16_000 and np.abs(frames[:, 0] - np.array(SINE * 3)[8_000:32_000]).max() < 1e-3


def test_flac_round_trip():
    rng = np.random.default_rng(3)
    for n in (1, 17, 4096, 4097, 70_000):
        x = rng.uniform(-1, 1, n)
        frames, rate, channels = S.decode_wav(S.encode_flac(x))
        assert rate == 16_000 and channels == 1 and (frames[:, 0] * 32768 == np.round(x * 32767)).all()
    broken = bytearray(S.encode_flac(rng.uniform(-1, 1, 5000)))
    broken[200] ^= 1
    with pytest.raises(ValueError, match="sum"):
        S.decode_wav(bytes(broken))


def test_flac_predictors():
    """Frames put together bit by bit: predicted samples, entropy codes, a constant, and a difference of channels."""
    from voxloom.functions import flac

    rice = lambda values, k: "00" + "0000" + format(k, "04b") + "".join("0" * (u >> k) + "1" + (format(u & (1 << k) - 1, f"0{k}b") if k else "") for u in ((2 * v if v >= 0 else -2 * v - 1) for v in values))
    two = lambda v, n: format(v & (1 << n) - 1, f"0{n}b")

    def file(channels, layout, *subframes, block=4):
        head = "".join(("111111111111100", "0", "0110", "0000", layout, "100", "0", "00000000", format(block - 1, "08b"), "00000000"))
        body = head + "".join(subframes)
        body += "0" * (-len(body) % 8) + "0" * 16
        info = (16 << 16 | 16).to_bytes(4, "big") + bytes(6) + (8000 << 44 | channels - 1 << 41 | 15 << 36 | block).to_bytes(8, "big") + bytes(16)
        return b"fLaC\x80" + len(info).to_bytes(3, "big") + info + int(body, 2).to_bytes(len(body) // 8, "big")

    want = [100, 103, 101, 90]
    fixed = "00010010" + two(100, 16) + rice([3, -2, -11], 2)
    assert flac.decode(file(1, "0000", fixed))[0][:, 0].tolist() == want
    linear = "01000000" + two(100, 16) + format(3, "04b") + two(1, 5) + two(2, 4) + rice([3, -2, -11], 1)  # order 1, weight 2 / 2
    assert flac.decode(file(1, "0000", linear))[0][:, 0].tolist() == want
    frames, rate, size = flac.decode(file(2, "1000", fixed, "00000000" + two(7, 17)))
    assert frames.tolist() == [[w, w - 7] for w in want] and (rate, size) == (8000, 16)


def test_samples_come_before_bytes_and_paths(spark, tmp_path):
    (tmp_path / "a.wav").write_bytes(wav(SINE))
    kind = "a struct<array: array<float>, sampling_rate: int, bytes: binary, path: string>"
    rows = [(([0.5, -0.25], 2, wav(SINE), "no"),), ((None, None, wav(SINE * 2), "no"),), ((None, None, None, f"{tmp_path}/a.wav"),), ((None, None, None, f"{tmp_path}/gone.wav"),), ((None, None, None, None),), (None,)]
    df = spark.createDataFrame(rows, kind)
    got = [r.m for r in df.select(S.measured(S.payload(df.schema["a"].dataType, F.col("a"))).alias("m")).collect()]
    assert [g.num_samples for g in got] == [2, 32_000, 16_000, None, None, None] and got[0].peak == 0.5 and got[3].error == "ValueError:no audio"
    assert got[0].audio_sha256 == hashlib.sha256(wav(SINE)).hexdigest() and got[2].audio_sha256 == hashlib.sha256(wav(SINE)).hexdigest()
    bare = spark.createDataFrame([(([0.5, -0.25], 2),)], "a struct<array: array<float>, sampling_rate: int>")
    got = bare.select(S.measured(S.payload(bare.schema["a"].dataType, F.col("a"))).alias("m")).first().m
    assert got.audio_sha256 == hashlib.sha256(b"2" + np.array([0.5, -0.25], "<f4").tobytes()).hexdigest()
