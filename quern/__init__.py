"""quern: analytics jobs as DataFrame -> DataFrame functions on PySpark."""
