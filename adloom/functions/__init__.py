"""Pure ``Column -> Column`` expressions."""
