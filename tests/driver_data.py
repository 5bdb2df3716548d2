"""Folders of the driver's tables.  (Not in conftest.py: a test folder below this one has its own module of that name.)"""

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"
