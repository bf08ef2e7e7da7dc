"""Trade-record analytics on PySpark: cleaning, labelling, rates, reports and price series."""
