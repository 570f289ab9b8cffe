"""Hospital readmission analytics as plain DataFrame transformations."""
