"""Property: the parse equals the anchored regex (Python ``re``) on random lines."""

import datetime as dt
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from walletyield.operators.logs import LOG_PATTERN, log_parse

PAT = re.compile(LOG_PATTERN)

word = st.text(alphabet="abcXYZ019_", min_size=1, max_size=6)
module = st.text(alphabet="abc.x_9", min_size=1, max_size=8)
junk = st.text(alphabet="ab :[].,-\t ", max_size=12)


@st.composite
def line(draw):
    t = draw(st.datetimes(min_value=dt.datetime(2020, 1, 1), max_value=dt.datetime(2030, 1, 1)))
    ts = t.strftime("%Y-%m-%d %H:%M:%S,") + f"{t.microsecond // 1000:03d}"
    kind = draw(st.integers(0, 3))
    if kind == 0:
        return draw(junk)
    sep = draw(st.sampled_from([": ", ":", " : "])) if kind == 1 else ": "
    return f"{ts} [{draw(word)}] {draw(module)}{sep}{draw(junk)}"


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(line(), min_size=20, max_size=60))
def test_parse_matches_regex(spark, lines):
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    parsed, unparsed = log_parse(df)
    got = sorted((r.datetime.strftime("%Y-%m-%d %H:%M:%S,%f")[:-3], r.level, r.module, r.message)
                 for r in parsed.collect())
    want = []
    for x in lines:
        m = PAT.match(x)
        if m:
            want.append(m.groups())
    assert got == sorted(want)
    assert unparsed.count() == len(lines) - len(want)
