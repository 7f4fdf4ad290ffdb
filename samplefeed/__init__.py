"""A feed made from the test tables, for the tests, the bench and the registered queries only.

One lineitem is one object, built row by row without grouping or joining, so the feed is as large
as the table and as even as its splits. Planted faults exercise the bad-input rules (k = l_orderkey):

    k % 23   hazard flag inverted (label noise)      k % 89   velocity text 'n/a'
    k % 53   empty approach list                     k % 97   hazard flag missing
    k % 61   loosely written date (1998-1-5)         k % 101  diameters missing
    k % 71   velocity text '1e999'                   k % 211  message cut to 20 characters
    k % 73   velocity text '-Infinity'               k % 79   velocity text 'Infinity'
    k % 83   velocity text 'NaN'
"""

from samplefeed.build import broken_envelopes, envelopes, form_rows, messages, objects, ship_dates
from samplefeed.oracle import CTES

__all__ = ["CTES", "broken_envelopes", "envelopes", "form_rows", "messages", "objects", "ship_dates"]
