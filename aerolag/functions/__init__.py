"""Column expressions: cleaning, casts and the categorical buckets."""
