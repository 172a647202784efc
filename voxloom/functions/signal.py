"""Waveform functions: higher-order functions on sample arrays, and Arrow functions for encoded audio."""

from __future__ import annotations

import hashlib
import io
import math
import wave

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import PandasUDFType
from pyspark.sql.types import BinaryType, StringType, StructType

from . import flac

SAMPLE_RATE = 16_000
DECODED = "samples array<float>, sample_rate int, channels int, error string"


def peak(w: Column) -> Column:
    return F.array_max(F.transform(w, lambda x: F.abs(x.cast("double"))))


def rms(w: Column) -> Column:
    """Root mean square in double precision; null for no samples."""
    return F.sqrt(F.try_divide(F.aggregate(w, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")), F.size(w)))


def decibels(v: Column) -> Column:
    """Relative to full scale; the floor is -240."""
    return 20 * F.log10(F.greatest(v, F.lit(1e-12)))


def seconds(w: Column, rate: Column) -> Column:
    return F.try_divide(F.size(w).cast("double"), rate)


def clipping_fraction(w: Column, level: float = 0.999) -> Column:
    return F.try_divide(F.size(F.filter(w, lambda x: F.abs(x.cast("double")) >= level)).cast("double"), F.size(w))


def is_valid(w: Column, rate: Column) -> Column:
    return (rate > 0) & (F.size(w) > 0) & F.forall(w, lambda x: ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))


def silence_threshold(w: Column) -> Column:
    """The amplitude below which a sample is silent: a hundredth of the peak, at least 1e-4; 0 for silence throughout."""
    top = F.coalesce(peak(w), F.lit(0.0))
    return F.when(top > 0, F.greatest(F.lit(1e-4), 0.01 * top)).otherwise(0.0)


def edge_silence(w: Column, rate: Column) -> Column:
    """``struct(leading, trailing, threshold)`` in seconds; the whole duration twice where nothing sounds."""
    level = silence_threshold(w)
    active = F.transform(w, lambda x: F.abs(x.cast("double")) >= level)
    first, last = F.array_position(active, True), F.array_position(F.reverse(active), True)
    none = (level == 0) | (first == 0)
    edge = lambda at: F.when(none, seconds(w, rate)).otherwise((at - 1).cast("double") / rate)
    return F.struct(edge(first).alias("leading"), edge(last).alias("trailing"), level.alias("threshold"))


def downmix(frames: Column) -> Column:
    """Mean over channels of ``[frames][channels]``; up to 8 rows longer than they are many are channels instead."""
    rows, cols = F.size(frames), F.size(F.get(frames, 0))
    turned = F.transform(F.sequence(F.lit(0), cols - 1), lambda i: F.transform(frames, lambda ch: F.get(ch, i)))
    mean = lambda a: F.transform(a, lambda f: F.aggregate(f, F.lit(0.0), lambda s, x: s + x.cast("double")) / F.size(f))
    return F.when((rows == 0) | (cols <= 0), F.array().cast("array<double>")).when((rows <= 8) & (cols > rows), mean(turned)).otherwise(mean(frames))


def trimmed(w: Column, start: Column, end: Column, rate: int = SAMPLE_RATE) -> Column:
    """Samples from round(start x rate) up to round(end x rate), halves to even."""
    a, b = F.bround(start * rate).cast("int"), F.bround(end * rate).cast("int")
    return F.slice(w, a + 1, F.greatest(b - a, F.lit(0)))


def usable_length(n: Column, least: int = SAMPLE_RATE, most: int = 40 * SAMPLE_RATE + 1) -> Column:
    return n.between(least, most)


def signed_to_binary(values: Column) -> Column:
    """Bytes of an array of signed bytes."""
    return F.unhex(F.concat_ws("", F.transform(values, lambda b: F.lpad(F.hex(b.cast("int").bitwiseAND(255)), 2, "0"))))


def bytes_fingerprint(data: Column) -> Column:
    return F.sha2(data, 256)


@F.pandas_udf(StringType())
def _sample_hash(samples: pd.Series, rate: pd.Series) -> pd.Series:
    return pd.Series([None if s is None else hashlib.sha256(str(int(r)).encode() + np.asarray(s, "<f4").tobytes()).hexdigest() for s, r in zip(samples, rate, strict=True)])


def sample_fingerprint(samples: Column, rate: Column) -> Column:
    """For audio without bytes: the rate as text, then little-endian floats. Not comparable with a hash of bytes."""
    return _sample_hash(samples, rate)


def decode_wav(data: bytes) -> tuple[np.ndarray, int, int]:
    """Frames by channels in [-1, 1), the rate and the channels of PCM and FLAC audio; other formats need soundfile."""
    if data[:4] == b"fLaC":
        frames, rate, size = flac.decode(data)
        return (frames / 2 ** (size - 1)).astype(np.float32), rate, frames.shape[1]
    if data[:4] != b"RIFF":
        import soundfile

        frames, rate = soundfile.read(io.BytesIO(data), dtype="float32", always_2d=True)
        return frames, rate, frames.shape[1]
    with wave.open(io.BytesIO(data)) as f:
        width, channels, rate = f.getsampwidth(), f.getnchannels(), f.getframerate()
        raw = f.readframes(f.getnframes())
    if width == 1:
        x = (np.frombuffer(raw, np.uint8).astype(np.float32) - 128) / 128
    elif width == 3:
        b = np.frombuffer(raw, np.uint8).reshape(-1, 3).astype(np.int32)
        x = ((b[:, 0] | b[:, 1] << 8 | b[:, 2] << 16) << 8 >> 8).astype(np.float32) / 2**23
    else:
        x = np.frombuffer(raw, {2: "<i2", 4: "<i4"}[width]).astype(np.float32) / 2 ** (8 * width - 1)
    return x.reshape(-1, channels), rate, channels


def mono(frames: np.ndarray) -> np.ndarray:
    if frames.ndim == 1:
        return frames
    if frames.ndim != 2:
        raise ValueError("audio has more than two dimensions")
    return frames.mean(0 if frames.shape[0] <= 8 and frames.shape[1] > frames.shape[0] else 1)


def _decoded(data: pd.Series) -> pd.DataFrame:
    rows = []
    for d in data:
        try:
            if d is None:
                raise ValueError("no audio")
            frames, rate, channels = decode_wav(bytes(d))
            x = mono(frames)
            if rate <= 0 or not len(x) or not np.isfinite(x).all():
                raise ValueError("empty or not finite")
            rows.append((x.astype(np.float32), rate, channels, None))
        except Exception as e:  # a row that can't be decoded is a result, not a failure of the job
            rows.append((None, None, None, f"{type(e).__name__}:{e}"))
    return pd.DataFrame(rows, columns=["samples", "sample_rate", "channels", "error"]).astype({"sample_rate": "Int32", "channels": "Int32"})


def decoded(data: Column) -> Column:
    """Mono samples, rate, channels, or the error, of encoded audio. Keep Arrow batches small for long audio
    (``spark.sql.execution.arrow.maxRecordsPerBatch`` around 64)."""
    return F.pandas_udf(_decoded, DECODED)(data)


def resample(x: np.ndarray, rate: int, to: int = SAMPLE_RATE) -> np.ndarray:
    """Polyphase resampling by a windowed sinc; the identity at the wanted rate."""
    if rate == to or not len(x):
        return x
    g = math.gcd(rate, to)
    up, down = to // g, rate // g
    half = 10 * max(up, down)
    t = np.arange(-half, half + 1)
    kernel = np.sinc(t / max(up, down)) * np.kaiser(2 * half + 1, 5.0)
    kernel *= up / kernel.sum()
    n = -(-len(x) * up // down)
    at = np.arange(n) * down  # places on the up-sampled grid
    out, first = np.zeros(n), (at - half + up - 1) // up
    for k in range(2 * half // up + 1):
        i = first + k
        tap = at - i * up + half
        ok = (i >= 0) & (i < len(x)) & (tap >= 0) & (tap <= 2 * half)
        out[ok] += x[i[ok]] * kernel[tap[ok]]
    return out.astype(np.float32)


def encode_wav(x: np.ndarray, rate: int = SAMPLE_RATE) -> bytes:
    """Mono 16-bit PCM; samples are cut to [-1, 1]."""
    buffer = io.BytesIO()
    with wave.open(buffer, "wb") as f:
        f.setnchannels(1)
        f.setsampwidth(2)
        f.setframerate(rate)
        f.writeframes(np.round(np.clip(x, -1, 1) * 32767).astype("<i2").tobytes())
    return buffer.getvalue()


def encode_flac(x: np.ndarray, rate: int = SAMPLE_RATE) -> bytes:
    """Mono 16-bit; samples are cut to [-1, 1]."""
    return flac.encode(np.round(np.clip(x, -1, 1) * 32767), rate)


PAYLOAD = "samples array<float>, rate int, data binary"


def _fetched(paths: pd.Series) -> pd.Series:
    import pyarrow.fs as fs

    def read(path):
        if path is None:
            return None
        try:
            system, at = fs.FileSystem.from_uri(path)
            with system.open_input_stream(at) as f:
                return f.read()
        except Exception:  # a file that isn't there is a recording that can't be decoded
            return None

    return paths.map(read)


def payload(kind: StructType, audio: Column) -> Column:
    """``struct`` of PAYLOAD of an audio column of bytes, or of a struct of ``array`` (with ``sampling_rate``), ``bytes`` and ``path``, of which the
    first that is there counts. Paths, URIs that all executors reach, are read where the rows are, and only where nothing else is there."""
    none = F.lit(None).cast("array<float>")
    if not isinstance(kind, StructType):
        return F.struct(none.alias("samples"), F.lit(None).cast("int").alias("rate"), audio.alias("data"))
    names = set(kind.names)
    samples = audio["array"].cast("array<float>") if "array" in names else none
    rate = audio["sampling_rate"].cast("int") if "sampling_rate" in names else F.lit(None).cast("int")
    data = audio["bytes"] if "bytes" in names else F.lit(None).cast("binary")
    if "path" in names:
        data = F.coalesce(data, F.pandas_udf(_fetched, "binary")(F.when(samples.isNull() & data.isNull(), audio["path"])))
    return F.struct(samples.alias("samples"), rate.alias("rate"), data.alias("data"))


def _read(samples, rate, data) -> tuple[np.ndarray, int, int]:
    if samples is not None:
        return np.asarray(samples, np.float32), int(rate), 1
    if data is None:
        raise ValueError("no audio")
    return decode_wav(bytes(data))


def _parts(audio) -> list[tuple]:
    """Samples, rate and bytes of each row of a batch: of bytes, or of a struct of PAYLOAD."""
    if isinstance(audio, pd.DataFrame):
        return [(s, None if pd.isna(r) else r, d) for s, r, d in zip(audio["samples"], audio["rate"], audio["data"], strict=True)]
    return [(None, None, d) for d in audio]


CODECS = {"wav": encode_wav, "flac": encode_flac}


def encoded(samples: Column, rate: int, codec: str = "flac") -> Column:
    """Mono 16-bit audio of an array of samples, null for null."""
    encode = CODECS[codec]

    def run(given: pd.Series) -> pd.Series:
        return given.map(lambda s: None if s is None else encode(np.asarray(s, np.float64), rate))

    return F.pandas_udf(run, "binary")(samples)


def _preparer(encode):
    def run(data, start, end):
        rows = []
        for given, a, b in zip(_parts(data), start, end, strict=True):
            try:
                frames, rate, _ = _read(*given)
                x = resample(mono(frames), rate)
                if not pd.isna(a):
                    x = x[round(a * SAMPLE_RATE) : round(b * SAMPLE_RATE)]
                if not SAMPLE_RATE <= len(x) <= 40 * SAMPLE_RATE + 1:
                    raise ValueError(f"{len(x)} samples")
                rows.append((np.frombuffer(encode(x), np.int8), len(x), None))
            except Exception as e:  # reported with its row, so one bad recording doesn't stop a run
                rows.append((None, None, f"{type(e).__name__}:{e}"))
        return pd.DataFrame(rows, columns=["audio_bytes", "audio_size", "error"]).astype({"audio_size": "Int64"})

    return run


def prepared(data: Column, start: Column, end: Column, codec: str = "flac") -> Column:
    """Decode, mix down, resample to 16 kHz, trim (null bounds: whole), check the length and encode (flac or wav):
    ``struct(audio_bytes, audio_size, error)``. data is bytes or a struct of PAYLOAD. Encoded bytes stay in buffers up to Arrow."""
    return F.pandas_udf(_preparer(CODECS[codec]), "audio_bytes array<tinyint>, audio_size long, error string", PandasUDFType.SCALAR)(data, start, end)


@F.pandas_udf(BinaryType())
def _joined(values: pd.Series) -> pd.Series:
    return values.map(lambda v: None if v is None else np.asarray(v, np.int8).tobytes())


def signed_to_binary_long(values: Column) -> Column:
    """As :func:`signed_to_binary`, for arrays too long for an expression per element."""
    return _joined(values)


# Measures of a recording, in the order of the audit table
MEASURES = (
    "decode_ok boolean, error string, sample_rate int, channels int, num_samples long, duration_seconds double, peak double, peak_dbfs double, rms double, rms_dbfs double, "
    "clipping_fraction double, leading_silence_seconds double, trailing_silence_seconds double, silence_amplitude_threshold double, audio_sha256 string"
)
_NAMES = [x.split()[0] for x in MEASURES.split(", ")]


def measure(data: bytes | None, samples=None, rate: int | None = None) -> tuple:
    """All measures of one recording, encoded or given as samples, in the order of MEASURES. Its hash is that of the bytes, if there are any."""
    try:
        frames, rate, channels = _read(samples, rate, data)
        x = mono(frames).astype(np.float32)
        if rate <= 0 or not len(x) or not np.isfinite(x).all():
            raise ValueError("empty or not finite")
        a = np.abs(x.astype(np.float64))
        top, level, seconds_ = float(a.max()), 0.0, len(x) / rate
        lead = trail = seconds_
        if top > 0:
            level = max(1e-4, 0.01 * top)
            active = np.flatnonzero(a >= level)
            lead, trail = active[0] / rate, (len(x) - 1 - active[-1]) / rate
        effective = float(np.sqrt(np.mean(a * a)))
        db = lambda v: 20 * math.log10(max(v, 1e-12))
        return (True, None, rate, channels, len(x), seconds_, top, db(top), effective, db(effective), float((a >= 0.999).mean()), lead, trail, level, _fingerprint(data, samples, rate))
    except Exception as e:  # a recording that can't be decoded is a result, not a failure of the job
        return (False, f"{type(e).__name__}:{e}".replace("|", "/"), *[None] * (len(_NAMES) - 2))


def _fingerprint(data, samples, rate) -> str:
    return hashlib.sha256(bytes(data) if data is not None else str(int(rate)).encode() + np.asarray(samples, "<f4").tobytes()).hexdigest()


def _measured(data):
    out = pd.DataFrame([measure(d, s, r) for s, r, d in _parts(data)], columns=_NAMES)
    return out.astype({"sample_rate": "Int32", "channels": "Int32", "num_samples": "Int64", **{n: "float64" for n in _NAMES[5:14]}})


def measured(data: Column) -> Column:
    """``struct`` of MEASURES of encoded audio, or of a struct of PAYLOAD, decoded once; for recordings too long for functions per element."""
    return F.pandas_udf(_measured, MEASURES, PandasUDFType.SCALAR)(data)
