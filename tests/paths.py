"""Folders that the tests read."""

import os

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"
