from eventwatch.operators.threshold import crossing, threshold_reached
from eventwatch.sources.adapter import load_table
from conftest import SF001


def test_number_of_elements_reached(spark):
    """25 elements: thresholds 23 and 25 fire once, 26 never (derived from the events table)."""
    ev = load_table(spark, SF001, "events").orderBy("event_id").limit(25)
    got = {r.threshold: r.message for r in threshold_reached(ev, [23, 25, 26]).collect()}
    assert got == {23: "read at least 23 messages", 25: "read at least 25 messages"}


def test_crossing_between_and_inside_batches():
    assert crossing(20, 5, 25) and crossing(24, 1, 25) and not crossing(25, 3, 25) and not crossing(0, 24, 25)
