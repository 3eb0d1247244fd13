"""Write modes."""
