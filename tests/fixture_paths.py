"""Paths that tests share (a module of its own: every folder of tests has a conftest)."""

import os

FIXTURES = os.path.join(os.path.dirname(os.path.abspath(__file__)), "fixtures")
