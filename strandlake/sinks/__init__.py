"""Writers: tables to text files."""
