"""Texts move once for the contexts of op5."""

from navloom.llm import suffix_dedup


def test_contexts_are_made_once(spark, monkeypatch):
    made, there, make = spark.sparkContext.accumulator(0), [], suffix_dedup._contexts

    def counted(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    def contexts(*args):
        table = make(*args)
        there.append(table.count())
        return table.mapInArrow(counted, table.schema)

    monkeypatch.setattr(suffix_dedup, "_contexts", contexts)
    passage = " ".join(f"word{n}" for n in range(40))
    rows = [(n, f"{'ab'[n % 2] * (n + 1)} {passage} {n * 7919}") for n in range(6)]
    found = suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert [row.n_removed > 0 for row in sorted(found)] == [False] + [True] * 5
    assert there[0] > 0 and made.value == there[0]
