"""Readers and writers."""
from .files import *  # noqa: F401,F403
