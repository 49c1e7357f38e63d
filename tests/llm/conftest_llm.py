"""Helpers of the tests here."""

import hashlib


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def as_set(df):
    return sorted(map(str, (tuple(r) for r in df.collect())))
