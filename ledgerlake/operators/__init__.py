"""DataFrame operators. Tables and columns are arguments; nothing here runs an action unless it says so."""
