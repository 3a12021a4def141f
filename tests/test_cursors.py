"""Loads by cursor with rows that come late, and with runs that die."""

from datetime import date, datetime

import pytest

from stratalake.plans import cursors
from stratalake.plans.ingest import IngestFailed
from stratalake.sinks.tables import table_name
from tests.conftest import rows_of

AT = datetime(2024, 1, 15, 12)
FIELDS = "id int, c date, note string"
D1, D2, D3 = (date(2024, 1, d) for d in (1, 2, 3))


@pytest.fixture
def load(spark, frame, tmp_path):
    places = [
        {"table": f"{label}_{tmp_path.name}", "path": str(tmp_path / label)}
        for label in ("late", "late_marks", "late_state")
    ]

    def run(*rows, keys=("id",)):
        return cursors.ingest_table_overlapping(
            spark, frame(FIELDS, *rows), "erp", "t", places[0], AT, "c", *places[1:],
            keys=list(keys) if keys else None,
        )

    run.ids = lambda: [r[0] for r in rows_of(spark.table(table_name(places[0])), "id")]
    run.places = places
    yield run
    for place in places:
        spark.sql(f"DROP TABLE IF EXISTS {table_name(place)}")


def test_late_rows_at_the_stored_value_and_without_one_load_once(load):
    first = [(1, D1, "a"), (2, D2, "b"), (3, None, "c")]
    assert (load(*first).records, load(*first).records) == (3, 0)
    more = [*first, (4, D2, "d"), (5, None, "e"), (6, D3, "f")]
    again = load(*more)
    assert (again.records, again.late) == (3, 2)
    assert load(*more).records == 0
    last = load(*more, (7, D3, "g"), (8, D2, "too late"))  # below the stored value: not looked for
    assert (last.records, last.late) == (1, 1)
    assert load.ids() == [1, 2, 3, 4, 5, 6, 7]


def test_a_row_that_gets_a_value_or_a_later_one_loads_again(load):
    load((1, D1, "a"), (2, None, "b"))
    assert load((1, D2, "a"), (2, D2, "b")).records == 2
    assert load((1, D2, "a"), (2, D2, "b")).records == 0


def test_without_keys_all_columns_name_a_row(load):
    assert load((1, D1, "a"), (1, D1, "a"), keys=None).records == 2
    assert load((1, D1, "a"), (1, D1, "changed"), keys=None).records == 1


def test_empty_and_valueless_sources(load):
    assert load().records == 0
    assert load((1, None, "a")).records == 1
    assert load((1, None, "a")).records == 0
    assert load((1, None, "a"), (2, D1, "b"), (3, None, "c")).late == 1
    assert load.ids() == [1, 2, 3]


@pytest.mark.parametrize("dies_at", range(4))
def test_a_run_may_die_at_any_write(load, monkeypatch, dies_at):
    """Before the announcement, the rows, the cursor value or the end."""
    load((1, D1, "a"))
    write, calls = cursors.write_table, []

    def dying(df, target, *mode):
        calls.append(target)
        if len(calls) == dies_at + 1:
            raise KeyboardInterrupt
        return write(df, target, *mode)

    rows = [(1, D1, "a"), (2, D1, "late"), (3, D2, "b"), (4, None, "c")]
    monkeypatch.setattr(cursors, "write_table", dying)
    with pytest.raises(KeyboardInterrupt):
        load(*rows)
    monkeypatch.setattr(cursors, "write_table", write)
    # Meanwhile one row has left its value, and one has come.
    rows = [*rows[:2], (3, D3, "moved"), rows[3], (5, None, "d")]
    load(*rows)
    assert load(*rows).records == 0
    wanted = [1, 2, 3, 4, 5] if dies_at < 2 else [1, 2, 3, 3, 4, 5]
    assert load.ids() == wanted


def test_an_ordinary_run_does_not_read_the_target(load, monkeypatch):
    load((1, D1, "a"))
    monkeypatch.setattr(cursors, "_arrived", lambda *_: pytest.fail("target was read"))
    assert load((1, D1, "a"), (2, D1, "b")).records == 1


def test_a_batch_of_another_size_is_an_error(spark, load, monkeypatch):
    write = cursors.write_table

    def half(df, target, *mode):
        if target is load.places[0]:
            write(df.limit(1), target, *mode)
            raise KeyboardInterrupt
        return write(df, target, *mode)

    monkeypatch.setattr(cursors, "write_table", half)
    with pytest.raises(KeyboardInterrupt):
        load((1, D1, "a"), (2, D1, "b"))
    monkeypatch.setattr(cursors, "write_table", write)
    with pytest.raises(IngestFailed):
        load((1, D1, "a"), (2, D1, "b"))
