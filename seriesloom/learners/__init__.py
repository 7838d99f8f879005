"""Learners: linear in SQL, least squares and boosted trees for every series, and one pooled Spark ML fit."""
