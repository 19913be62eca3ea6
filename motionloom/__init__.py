"""motionloom: trajectory quality, cleaning and calibration on Spark DataFrames."""

__version__ = "0.1.0"
