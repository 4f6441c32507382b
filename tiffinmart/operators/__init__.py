"""DataFrame operators: cleaning, upsert, change feeds, SCD2, star join, masking, quality."""
