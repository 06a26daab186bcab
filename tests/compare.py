"""Order-free comparison of two pandas frames with the same columns."""


def plain(df):
    cols = sorted(df.columns)
    df = df[cols].copy()
    for c in cols:
        kind = str(df[c].dtype)
        if df[c].dtype.kind == "f" or kind.startswith("decimal"):
            df[c] = df[c].astype(float).map(lambda v: f"{v:.9g}")
        elif "datetime" in kind:
            df[c] = df[c].astype("datetime64[us]").astype(str)
        else:
            df[c] = df[c].astype(str)
        df[c] = df[c].str.replace(r" 00:00:00$", "", regex=True).replace({"None": "nan", "<NA>": "nan", "NaT": "nan"})
        df[c] = df[c].str.replace(r"^(-?\d+)\.0$", r"\1", regex=True)
    return df.sort_values(cols).reset_index(drop=True)


def same(a, b):
    assert sorted(a.columns) == sorted(b.columns)
    a, b = plain(a), plain(b)
    assert len(a) == len(b)
    for c in a.columns:
        wrong = a[c] != b[c]
        assert not wrong.any(), (c, a[c][wrong].head(3).tolist(), b[c][wrong].head(3).tolist())
