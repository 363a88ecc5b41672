"""webmeter: web-analytics counting and corpus operators on PySpark."""
