"""Result-table merges (upserts) as DataFrame functions, and writers."""
