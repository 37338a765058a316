"""Property: the three E10 paths equal a plain in-order fold on random inputs."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from glyphlex.operators import dictionaries as D
from glyphlex.operators import substitute as S

ALPHABET = "ab🐶🐱狗猫 "
keys = st.text(alphabet=ALPHABET, min_size=1, max_size=3)
vals = st.text(alphabet=ALPHABET, min_size=0, max_size=3)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(entries=st.dictionaries(keys, vals, min_size=0, max_size=8),
       texts=st.lists(st.text(alphabet=ALPHABET, max_size=20), min_size=1, max_size=25))
def test_fold_paths_equal_python(spark, entries, texts):
    d = D.from_mapping(spark, entries)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")

    def py(t):
        for k, v in entries.items():
            t = t.replace(k, v)
        return t
    want = [py(t) for t in texts]
    for path, extra in [("native", {}), ("arrow", {}), ("chunked", {"chunk_bytes": 7})]:
        got = [r.o for r in S.apply_fold(df, "t", d, "o", path=path, **extra)
               .orderBy("i").collect()]
        assert got == want, path
