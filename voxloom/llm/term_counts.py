"""Frequency of every distinct term (problem 3): an external sort by range of (term, record) pairs,
then a scan of run lengths."""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize, partitions
from .one_form import with_one_form, words_of


def _run_lengths(words: str) -> Column:
    """Distinct values of an ascending array with how often each stands in it."""
    return F.expr(f"""transform(filter(sequence(1, size({words})), i -> i = 1 or element_at({words}, i) <> element_at({words}, i - 1)),
        (i, k) -> named_struct('term', element_at({words}, i), 'first', i))""")


def _scan(batches):
    """Occurrences and records of each term, from sorted (term, record, n). A term whose run goes
    on in another task gives a partial count there; repeated deliveries of a record count once."""
    last: tuple | None = None  # term, record, n of that record, occurrences and records before it
    for batch in batches:
        if not batch.num_rows:
            continue
        term, record, n = batch.column("term"), batch.column("record_no").to_numpy(), batch.column("n").to_numpy()
        rows = batch.num_rows
        other = np.ones(rows, bool)
        other[1:] = pc.not_equal(term.slice(1), term.slice(0, rows - 1)).to_numpy(zero_copy_only=False)
        if last is not None:
            other[0] = term[0].as_py() != last[0]
        anew = other.copy()
        anew[1:] |= record[1:] != record[:-1]
        if last is not None:
            anew[0] = other[0] or record[0] != last[1]
        heads = np.flatnonzero(anew)  # one per (term, record), but for the run carried over
        carried = 0 if len(heads) and heads[0] == 0 else (heads[0] if len(heads) else rows)
        if carried:
            last = (last[0], last[1], max(last[2], int(n[:carried].max())), last[3], last[4])
        if not len(heads):
            continue
        most = np.maximum.reduceat(n, heads)
        start = np.flatnonzero(other[heads])  # heads at which a term begins
        out_terms, out_n, out_r = [], [], []
        before = start[0] if len(start) else len(heads)
        if last is not None:
            total = (last[0], last[3] + last[2] + int(most[:before].sum()), last[4] + 1 + int(before))
        if len(start):
            if last is not None:
                out_terms, out_n, out_r = [total[0]], [total[1]], [total[2]]
            sums, counts = np.add.reduceat(most[start[0] :], start - start[0]), np.diff(np.append(start, len(heads)))
            names = term.take(pa.array(heads[start]))
            out_terms += names[:-1].to_pylist()
            out_n += sums[:-1].tolist()
            out_r += counts[:-1].tolist()
            last = (names[-1].as_py(), int(record[-1]), int(most[-1]), int(sums[-1] - most[-1]), int(counts[-1] - 1))
        else:
            last = (last[0], int(record[-1]), int(most[-1]), total[1] - int(most[-1]), total[2] - 1)
        if out_terms:
            yield pa.RecordBatch.from_arrays([pa.array(out_terms, pa.string()), pa.array(out_n, pa.int64()), pa.array(out_r, pa.int64())], ["term", "occurrences", "records"])
    if last is not None:
        yield pa.RecordBatch.from_arrays([pa.array([last[0]], pa.string()), pa.array([last[3] + last[2]], pa.int64()), pa.array([last[4] + 1], pa.int64())], ["term", "occurrences", "records"])


def term_counts(audit: DataFrame, common_share: float = 0.1) -> DataFrame:
    """``(term, occurrences, records, mark)`` for each term of ``text_normalized`` in the one form, lower case.

    mark is 'rare' for terms of exactly one record, 'common' for those of more than ``common_share`` of
    all records (records without text count in the total), null for the others. Deliveries of
    a record hold the same text; where they differ, the greater count of a term holds. Null,
    empty and blank texts give no terms. The sort key holds the record, so the rows of a hot term
    spread over as many tasks as they need; each task's partial counts are summed at the end.
    """
    spark = audit.sparkSession
    total = audit.select("record_no").distinct().count()
    forms = with_one_form(audit.select("record_no", "text_normalized"), "text_normalized")
    words = forms.select("record_no", F.array_sort(words_of(F.lower("form"))).alias("w")).filter("size(w) > 0")
    runs = words.withColumn("t", _run_lengths("w"))
    ends = F.expr("transform(t, (x, k) -> named_struct('term', x.term, 'n', coalesce(get(t, k + 1).first, size(w) + 1) - x.first))")
    # written once: the bounds of the ranges are drawn from the pairs before they are sorted
    pairs = materialize(runs.select("record_no", F.explode(ends).alias("x")).select("x.term", "record_no", "x.n"), "pairs")
    ordered = pairs.repartitionByRange(partitions(spark), "term", "record_no").sortWithinPartitions("term", "record_no")
    partial = ordered.mapInArrow(_scan, "term string, occurrences long, records long")
    counts = partial.groupBy("term").agg(F.sum("occurrences").alias("occurrences"), F.sum("records").alias("records"))
    # a record's equal rows lie in one task, for they have one sort key: partial record counts never overlap
    most = int(Fraction(str(common_share)) * total)  # whole numbers: a term in exactly the share isn't common
    mark = F.when(F.col("records") == 1, "rare").when(F.col("records") > most, "common")
    return counts.withColumn("mark", mark)
