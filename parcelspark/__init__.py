"""Parcel-carrier analytics on Spark: reusable operators and finished report jobs."""
