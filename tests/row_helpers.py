"""Helpers shared by the tests."""


def by(df, *keys):
    """Collected rows keyed by the given columns."""
    return {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r for r in df.collect()}
