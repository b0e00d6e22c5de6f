"""DataFrame -> DataFrame operators. None of them runs an action unless it says so."""
