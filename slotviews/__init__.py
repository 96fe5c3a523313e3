"""Time-slotted analytical views, data quality and journey analytics on Spark."""
