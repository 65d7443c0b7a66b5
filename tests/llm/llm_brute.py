"""Plain versions that several tests share."""

import re


def lower(text):
    """A-Z alone in lower case."""
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
