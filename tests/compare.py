def rows(df):
    cols = sorted(df.columns)
    clean = df[cols].round(6).astype(object)
    clean = clean.where(df[cols].notna(), None)
    return cols, sorted(repr(tuple(float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v) for v in r)) for r in clean.itertuples(index=False, name=None))
