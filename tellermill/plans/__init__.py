"""Tables, views, reports and jobs composed from the rules and operators."""
