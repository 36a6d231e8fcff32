"""Helpers that the test modules import; fixtures are in conftest.py."""

import os

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


def local_path(uri: str) -> str:
    return uri[len("file:"):] if uri.startswith("file:") else uri


def plan_text(df, mode="formatted") -> str:
    """The physical plan as ``explain`` prints it."""
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()
