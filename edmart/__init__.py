"""edmart: course-catalogue operations and higher-education statistics on Spark."""

__version__ = "0.1.0"
