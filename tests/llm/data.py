"""Small tables and plain-Python versions of the problems, for comparison."""

from __future__ import annotations

import datetime as dt
import unicodedata

from voxloom.llm import unicode_tables as U

AUDIT = (
    "source string, dataset_id string, split string, row_index long, example_id string, speaker_id string, text_raw string, text_normalized string, duration_seconds double, record_no long, loaded_at timestamp,"
    # names that the operators use themselves
    "form string, field string, h1 long, h2 long, text string, seq string, cid long, words string, code string, speaker string, component string, term string, n int, points string, key string"
)
MANIFEST = "review_id string, segment_boundaries_seconds string, reviewed_at timestamp, duration_ms string, points string, typed string, text string"
DOCUMENTS = "doc_id long, text string, lang string, source string, ids string, tokens string, domain string, wanted string, labelled string, start_at string, u int, mix string"


def day(n: int) -> dt.datetime:
    return dt.datetime(2025, 1, 1) + dt.timedelta(days=n)


def audit(spark, rows):
    """rows: (record_no, split, text_normalized[, text_raw, source, speaker, duration, loaded day])."""
    full = []
    for r in rows:
        no, split, norm, raw, source, speaker, seconds, loaded = (*r, *[None, None, "studio", None, 5.0, 0][len(r) - 2 :])[:8] if len(r) < 8 else r
        full.append((source, "d", split, no, f"e{no}", speaker, raw, norm, seconds, no, None if loaded is None else day(loaded), "x", "x", 1, 2, "x", "x", 3, "x", "x", "x", "x", "x", 4, "x", "x"))
    return spark.createDataFrame(full, AUDIT)


def manifest(spark, rows):
    return spark.createDataFrame([(a, b, None if d is None else day(d), "x", "x", "x", "x") for a, b, d in rows], MANIFEST)


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, *["x"] * 6, 1, "x") for i, t, s in rows], DOCUMENTS)


def one_form(text):
    if text is None:
        return None
    out = []
    plain = "".join(" " if c.isspace() else "" if U._invisible(ord(c)) else "'" if c in U.APOSTROPHES else c for c in text)
    wide = lambda c: unicodedata.decomposition(c).startswith(("<wide>", "<narrow>")) or ord(c) in U.LIGATURES and unicodedata.decomposition(c) != ""
    while any(map(wide, plain)):
        plain = "".join("".join(chr(int(x, 16)) for x in unicodedata.decomposition(c).split()[1:]) if wide(c) else c for c in plain)
    for w in plain.split():
        w = unicodedata.normalize("NFD", w)
        latin = any(c.isalpha() and unicodedata.name(c, "").startswith("LATIN") for c in w)
        other = any(c.isalpha() and not unicodedata.name(c, "").startswith("LATIN") and c not in U.LOOK_ALIKES for c in w)
        out.append(unicodedata.normalize("NFC", "".join(U.LOOK_ALIKES.get(c, c) for c in w) if latin and not other else w))
    return " ".join(out)


def near(rows, share=0.6):
    """Pairs of records whose word sets have at least this in common, with equality of their texts."""
    sets = {no: (split, frozenset(one_form(norm).split()), one_form(norm)) for no, split, norm in rows if norm}
    sets = {k: v for k, v in sets.items() if len(v[1]) >= 10}
    for a in sets:
        for b in sets:
            if a < b and len(sets[a][1] & sets[b][1]) >= share * len(sets[a][1] | sets[b][1]) - 1e-9:
                yield a, b, sets[a], sets[b]
