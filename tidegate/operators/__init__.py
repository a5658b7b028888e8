"""Joins, rankings, quantiles and checks that hold up under skew."""
