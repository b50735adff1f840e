"""Production-line analytics on Spark DataFrames.

Reads machine sensor readings and quality inspections, cleans and
standardises them, joins them on time and machine, rolls them up per hour,
writes three tables and answers a fixed set of analysis queries and data
checks over them.  See README.md.
"""

__version__ = "0.1.0"
